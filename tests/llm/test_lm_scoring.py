import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from odometrix.llm import attention_model as am
from odometrix.llm.lm_scoring import (
    END_ID,
    TRAIN_WINDOWS,
    VOCABULARY_SIZE,
    _gather,
    _subword_counts,
    score_classes,
    score_documents,
    training_windows,
)
from odometrix.llm.subwords import WordEncoder, tokenizer_path
from tests.llm.helpers import LOW, documents, hard_rows, words


def vocabulary(seed=0, size=600):
    r = np.random.default_rng(seed)
    return am.Vocabulary.from_counts(r.zipf(1.5, size).clip(0, 10_000), r.random(size) < 0.5)


def test_probabilities_are_normalised():
    v = vocabulary()
    inside = np.bincount(v.class_of, weights=np.exp(v.inside.astype("f8")), minlength=am.CLASSES - 1)
    used = np.bincount(v.class_of, minlength=am.CLASSES - 1) > 0
    assert np.allclose(inside[used], 1, atol=1e-4)
    w = am.initial_weights(v) + np.random.default_rng(1).standard_normal(am.SIZE).astype("f4") * 0.1
    given = np.random.default_rng(2).integers(0, am.CLASSES, (1, am.WINDOW))
    total = 0.0
    for c in range(am.CLASSES - 1):
        scored = np.zeros((1, am.WINDOW), bool)
        scored[0, -1] = True
        total += math.exp(am.log_probabilities(w, given, np.full((1, am.WINDOW), c), scored)[0])
    assert abs(total - 1) < 1e-3


def test_gradient():
    r = np.random.default_rng(0)
    w = (am.initial_weights(vocabulary()) + r.standard_normal(am.SIZE) * 0.2).astype("f4")
    given, wanted = r.integers(0, am.CLASSES, (3, am.WINDOW)), r.integers(0, am.CLASSES - 1, (3, am.WINDOW))
    real = r.random((3, am.WINDOW)) < 0.8
    _, g = am._gradient(w, given, wanted, real)
    for i in r.integers(0, am.SIZE, 20):
        d = np.zeros(am.SIZE, "f4")
        d[i] = 1e-2
        up, down = (am._gradient(w + s * d, given, wanted, real)[0] for s in (1, -1))
        slope = (up - down) / 2e-2 / real.sum()
        assert abs(slope - g[i]) < 3e-3 + 0.05 * abs(g[i])


def test_attention_is_causal_and_each_token_scored_once():
    r = np.random.default_rng(3)
    w = am.initial_weights(vocabulary())
    for n in (1, 2, 15, 16, 17, 30, 31, 200):
        classes = r.integers(0, am.CLASSES - 1, n)
        given, wanted, scored = am.windows_of(classes)
        assert scored.sum() == n and (wanted[scored] == classes).all()
        logs = am.log_probabilities(w, given, wanted, scored)
        assert abs(score_classes(w, [classes])[0] - logs.sum()) < 1e-2
        if n > 40:
            changed = classes.copy()
            changed[40:] = (changed[40:] + 1) % (am.CLASSES - 1)
            before = am.log_probabilities(w, *am.windows_of(changed))[:40]
            assert np.allclose(before, logs[:40], atol=1e-4)


def test_training_lowers_the_loss():
    v = vocabulary()
    classes = np.tile(np.arange(12), 400)
    given, wanted, scored = am.windows_of(classes)
    w = am.initial_weights(v)
    trainer = am.Trainer(w, 40 * len(given))
    for k in range(40):
        trainer.learn(given, wanted, scored, seed=k)
    trained = trainer.weights
    assert am.log_probabilities(trained, given, wanted, scored).mean() > am.log_probabilities(w, given, wanted, scored).mean() + 1


def brute_base(rows):
    counts: Counter = Counter()
    for i, t, _ in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            counts.update(words((t or "").translate(LOW)))
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t, _ in rows:
        tokens = [*words((t or "").translate(LOW)), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        held = zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
        out.append((str(i), held, len(tokens), sum(counts[w] > 0 for w in tokens), n, round(base, 4)))
    return sorted(out)


@pytest.mark.parametrize("top_words", [200_000, 5])
def test_base_scores_match_brute_force(spark, top_words):
    rows = [r for r in hard_rows() if r[1] is None or len(r[1]) < 50_000]
    got = score_documents(documents(spark, rows), top_words=top_words, rounds=1).collect()
    assert sorted(
        (str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got
    ) == brute_base(rows)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_held_out_score_beats_word_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = score_documents(docs).filter("held_out").toPandas()
    untrained = score_documents(docs, rounds=0).filter("held_out").toPandas()
    assert got["score"].sum() > untrained["score"].sum() * 0.97
    assert got["score"].sum() > got["base_score"].sum()


def test_scorer_matches_the_plain_forward_pass():
    """Against ``_attend`` and a softmax over all classes of a group."""
    r = np.random.default_rng(5)
    for scale in (0.2, 3.0):  # with 3.0 exp needs the maximum taken off
        w = (am.initial_weights(vocabulary()) + r.standard_normal(am.SIZE) * scale).astype("f4")
        given, wanted = r.integers(0, am.CLASSES, (7, am.WINDOW)), r.integers(0, am.CLASSES - 1, (7, am.WINDOW))
        scored = r.random((7, am.WINDOW)) < 0.7
        p = am.unpack(w)
        hidden = am._attend(p, given)[0].astype("f8")
        want = []
        for i, j in zip(*np.nonzero(scored), strict=True):
            h, (g, k) = np.append(hidden[i, j], 1), divmod(int(wanted[i, j]), am.PLACES)
            logits = (h @ p["group"], h @ p["member"][g])
            want.append(sum(x[c] - x.max() - np.log(np.exp(x - x.max()).sum()) for x, c in zip(logits, (g, k), strict=True)))
        got = am.Scorer(w).log_probabilities(given, wanted, scored)
        assert np.allclose(got, want, rtol=2e-3, atol=2e-3)


def test_scores_do_not_hang_on_the_split(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    # Many workers, so that the sums take a tree.
    runs = [
        sorted((r.doc_id, r.score) for r in score_documents(docs.repartition(n), worker_subwords=2_000).collect())
        for n in (2, 7)
    ]
    assert len(runs[0]) == docs.count()
    assert all(a[0] == b[0] and abs(a[1] - b[1]) <= 1e-4 * abs(b[1]) for a, b in zip(*runs, strict=True))


def test_empty_table(spark):
    assert score_documents(documents(spark, hard_rows()).limit(0)).count() == 0


def test_training_covers_every_training_text():
    path = tokenizer_path()
    encoder = WordEncoder(path)
    rows = [(i, t) for i, t, _ in hard_rows()] + [(1000 + i, f"start {'word and others ' * 900} end{i}") for i in range(20)]
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows])], ["id", "text"])
    gathered = [b.column(2).drop_null() for b in _gather(path)(iter([batch]))]
    texts = [ids for c in gathered for ids in c.to_pylist()]
    class_of = (np.arange(VOCABULARY_SIZE) % (am.CLASSES - 1)).astype("i2")
    want = Counter()
    for i, t in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            want.update(class_of[np.frombuffer(encoder.encode(t or ""), "<u4")].tolist())
            want[int(class_of[END_ID])] += 1
    got = Counter()
    for given, wanted, scored in training_windows(iter(texts), class_of):
        assert len(given) <= TRAIN_WINDOWS
        got.update(wanted[scored].tolist())
    assert got == want


def test_every_token_sees_half_a_window_or_all_before_it():
    n = 300
    given, wanted, scored = am.windows_of(np.arange(n))
    window, position = np.nonzero(scored)
    assert am.STRIDE <= am.WINDOW // 2
    assert all(p + 1 >= min(w + 1, am.WINDOW // 2) for p, w in zip(position, wanted[window, position], strict=True))


def test_repeated_rows_are_dealt_apart():
    batch = pa.RecordBatch.from_arrays([pa.array([4] * 300), pa.array(["the same text"] * 300)], ["id", "text"])
    deals = [d for b in _gather(tokenizer_path())(iter([batch])) for d in b.column(3).to_pylist() if d is not None]
    assert len(deals) == 300 and len({d % 64 for d in deals}) > 50


def test_subwords_are_counted_from_the_stored_ids():
    """No word is encoded again for the counts."""
    r = np.random.default_rng(4)
    texts = [r.integers(0, VOCABULARY_SIZE, n).astype("<u2") for n in (0, 1, 700, *range(300))]
    batches = [pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in part], pa.binary())], ["ids"]) for part in (texts[:5], texts[5:])]
    (got,) = _subword_counts(iter(batches))
    want = Counter(np.concatenate(texts).tolist())
    assert dict(zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True)) == want


def test_overlapping_windows_attend_from_their_new_positions_only(monkeypatch):
    starts = Counter()
    plain = am.Scorer._hidden

    def counted(self, given, scored, start):
        starts[start] += len(given)
        return plain(self, given, scored, start)

    monkeypatch.setattr(am.Scorer, "_hidden", counted)
    given, wanted, scored = am.windows_of(np.arange(300))
    am.log_probabilities(am.initial_weights(vocabulary()), given, wanted, scored)
    assert starts == {0: 1, am.WINDOW - am.STRIDE: len(given) - 1}


def test_steps_match_plain_adam():
    r = np.random.default_rng(6)
    w = am.initial_weights(vocabulary())
    given, wanted = r.integers(0, am.CLASSES, (40, am.WINDOW)), r.integers(0, am.CLASSES - 1, (40, am.WINDOW))
    real = r.random((40, am.WINDOW)) < 0.9
    trainer = am.Trainer(w, 10**9, batch=16)
    trainer.learn(given, wanted, real, seed=3)
    order, want = np.random.default_rng(3).permutation(40), w.astype("f8")
    mean, square = np.zeros(am.SIZE), np.zeros(am.SIZE)
    for step, at in enumerate(range(0, 40, 16), 1):
        part = order[at : at + 16]
        g = am._gradient(want.astype("f4"), given[part], wanted[part], real[part])[1].astype("f8")
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        want -= am.RATE * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    # A gradient near the constant 1e-8 may round either way.
    assert np.mean(np.abs(trainer.weights - want) < 1e-4) > 0.999
