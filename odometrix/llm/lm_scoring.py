"""Language-model scoring with a causal self-attention model trained in numpy.

Documents whose crc32(id as text) mod 7 is 2 are held out; all others train.

1. One pass over all texts gathers, from the training ones, the count of every
   word and end token, and the subword ids of the whole text, end token included.
2. The subwords of those ids are counted. The counts give the classes
   (``attention_model``).
3. Local SGD: texts are dealt by hash to ``ROUNDS`` rounds, and in each round to
   workers of about ``WORKER_SUBWORDS`` subwords, a number that follows from the
   subword count alone; each worker takes its texts in hash order. In a round every
   worker trains from the same weights on windows that lie side by side and cover
   its texts whole; then the weights are averaged by windows in a tree of Spark
   stages. The rounds together learn every training subword once, at a falling
   rate. Scores so hang on the rows, not on how the input is
   split over files and tasks; only the copies of a fully repeated row are dealt as
   they lie in batches of 256, so that no worker gets them all.
4. One pass scores all texts in overlapping windows, each token once, in batches
   of masked attention. The base score uses word counts: those of the
   ``TOP_WORDS`` most frequent words are sent to the tasks (a bounded table); the
   others of a document are joined to the counts as (row, word) rows. Frequent
   words never reach that join, so it has no hot keys.

Defined results: a null text counts as empty (one end token); a null id reads as
the empty text, so it trains; repeated rows train and are scored as separate
documents; with no training text at all N is 0 and V is 0; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odometrix.llm import attention_model as am
from odometrix.llm.common import materialize, read_table, ship_package
from odometrix.llm.subwords import tokenizer_path, word_encoder

FOLDS, HELD_OUT = 7, 2
ROUNDS = 8
WORKER_SUBWORDS = 1_000_000  # a worker learns in one round
FAN_IN = 32  # weight vectors summed at once
TOP_WORDS = 100_000
VOCABULARY_SIZE = 49_408
END_ID = 49_407  # the tokenizer's own end-of-text id closes every text
END_WORD = b""  # no word is empty, so the end token needs no name of its own
FLUSH_WORDS = 200_000  # different words a task holds before it hands on counts
SCORE_WINDOWS = 512
TRAIN_WINDOWS = 10_000  # windows a task shuffles and trains on at a time


def remainder(id_) -> int:
    return zlib.crc32(("" if id_ is None else str(id_)).encode()) % FOLDS


END = END_ID.to_bytes(4, "little")


def _gather(path: str):
    """(word, n, ids, deal): counts of training words; 16-bit subword ids of each
    whole training text and its end token, and a hash to deal it by, which also
    tells repeated rows of 256 apart."""

    def rows(counts: dict, texts: list[bytes], deals: list[int]) -> pa.RecordBatch:
        none = [None] * len(texts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([*counts.keys(), *none], pa.binary()),
                pa.array([*counts.values(), *none], pa.int64()),
                pa.array([None] * len(counts) + texts, pa.binary()),
                pa.array([None] * len(counts) + deals, pa.int64()),
            ],
            names=["word", "n", "ids", "deal"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        counts: Counter = Counter()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch, texts, deals, copies = whole.slice(at, 256), [], [], Counter()
                for id_, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    if remainder(id_) == HELD_OUT:
                        continue
                    words = (text.as_py() or "").encode("utf-8", "replace").lower().split()
                    counts.update(words)
                    counts[END_WORD] += 1
                    ids = encoder.encode_words(words) + END
                    texts.append(np.frombuffer(ids, "<u4").astype("<u2").tobytes())
                    own = xxhash.xxh64_intdigest(texts[-1], zlib.crc32(str(id_).encode()))
                    deals.append(xxhash.xxh64_intdigest(f"{own}:{copies[own]}") >> 1)
                    copies[own] += 1
                yield rows({}, texts, deals)
            if len(counts) > FLUSH_WORDS:
                yield rows(counts, [], [])
                counts = Counter()
        yield rows(counts, [], [])

    return run


def _subword_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n) of the subwords in a column of texts (16-bit ids)."""
    total = np.zeros(VOCABULARY_SIZE, "i8")
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            ids = b"".join(whole.column(0).slice(at, 256).to_pylist())
            total += np.bincount(np.frombuffer(ids, "<u2"), minlength=VOCABULARY_SIZE)
    ids = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])


def training_windows(texts: Iterable[bytes], class_of: np.ndarray):
    """(given, wanted, scored) of windows side by side over whole ``texts`` (16-bit
    subword ids), ``TRAIN_WINDOWS`` at a time."""
    held: list[tuple] = []
    n = 0
    for ids in texts:
        classes = class_of[np.frombuffer(ids, "<u2")].astype("i8")
        held.append(am.windows_of(classes, am.WINDOW))
        n += len(held[-1][0])
        if n >= TRAIN_WINDOWS:
            parts = [np.concatenate(k) for k in zip(*held, strict=True)]
            full = n - n % TRAIN_WINDOWS
            for at in range(0, full, TRAIN_WINDOWS):
                yield tuple(k[at : at + TRAIN_WINDOWS] for k in parts)
            held, n = [tuple(k[full:].copy() for k in parts)], n - full
    if n:
        yield tuple(np.concatenate(k) for k in zip(*held, strict=True))


_TRAINED = "worker int, weights binary, n long"


def _trained(worker: int, weights: np.ndarray, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([worker], pa.int32()), pa.array([weights.tobytes()], pa.binary()), pa.array([n], pa.int64())],
        names=["worker", "weights", "n"],
    )


def _local_training(weights: np.ndarray, class_of: np.ndarray, seed: int, expected: int, done: int):
    """(worker, weights, n): each worker's weights after its n windows, times n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((w, t.as_py()) for b in batches for w, t in zip(b.column(0).to_pylist(), b.column(1), strict=True))
        for worker, own in groupby(rows, key=itemgetter(0)):
            trainer = am.Trainer(weights, expected, done=done)
            for k, windows in enumerate(training_windows((ids for _, ids in own), class_of)):
                trainer.learn(*windows, seed=seed + k)
            yield _trained(worker, trainer.weights.astype("f8") * trainer.windows, trainer.windows)

    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for the rows of a task, in their order: the sums."""
    least, total, n = None, np.zeros(am.SIZE), 0
    for batch in batches:
        for row in batch.to_pylist():
            least = row["worker"] if least is None else least
            total += np.frombuffer(row["weights"])
            n += row["n"]
    if least is not None:
        yield _trained(least, total, n)


def train_model(
    texts: DataFrame, vocabulary: am.Vocabulary, subwords: int, n_texts: int, rounds: int = ROUNDS,
    worker_subwords: int = WORKER_SUBWORDS,
) -> np.ndarray:
    """Weights averaged over workers after each round of local SGD. ``texts``:
    deal, ids; ``subwords`` and ``n_texts`` are their totals."""
    weights = am.initial_weights(vocabulary)
    if not rounds:
        return weights
    workers = max(1, -(-subwords // (worker_subwords * rounds)))
    # A round and worker learn about so many windows: a text's last one is half full.
    each = int((subwords / am.WINDOW + n_texts / 2) / (workers * rounds))
    worker = F.expr(f"(deal div {rounds}) % {workers}")
    for r in range(rounds):
        dealt = (
            texts.filter(F.col("deal") % rounds == r)
            .select(worker.cast("int").alias("worker"), "ids", "deal")
            .repartitionById(workers, F.col("worker"))
            .sortWithinPartitions("worker", "deal")
            .select("worker", "ids")
        )
        training = _local_training(weights, vocabulary.class_of, r, each * rounds, each * r)
        trained = dealt.mapInArrow(training, _TRAINED)
        left = workers
        while left > FAN_IN:
            left = -(-left // FAN_IN)
            to = F.pmod("worker", F.lit(left)).cast("int")
            trained = trained.repartitionById(left, to).sortWithinPartitions("worker").mapInArrow(_add_up, _TRAINED)
        # At most FAN_IN vectors of a size fixed by the model come back.
        rows = sorted(trained.collect())
        if rows:
            total = sum(np.frombuffer(row.weights) for row in rows)
            weights = (total / sum(row.n for row in rows)).astype("f4")
    return weights


def frequent_words(counts: DataFrame, most: int) -> DataFrame:
    """(word, c) of at most ``most`` words, all at least as frequent as any word
    left out: whole steps of an eighth of a power of two, found from one count
    for each step (a few hundred)."""
    step = F.floor(F.log2("c") * 8)
    steps = counts.filter("c > 0").groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    least, taken = math.inf, 0
    for row in sorted(steps, key=lambda r: -r.step):
        taken += row.n
        if taken > most:
            break
        least = row.step
    return counts.filter(step >= F.lit(float(least)))


def score_classes(weights: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
    """Sum of log P(class) of each text (arrays of class ids), in batches of
    windows that may hold several texts."""
    out = np.zeros(len(texts))
    scorer = am.Scorer(weights)
    pending: list[tuple] = []
    owners: list[np.ndarray] = []
    held = 0

    def run() -> None:
        nonlocal pending, owners, held
        given, wanted, scored = (np.concatenate([p[k] for p in pending]) for k in range(3))
        owner = np.concatenate(owners)
        for at in range(0, len(given), SCORE_WINDOWS):
            part = slice(at, at + SCORE_WINDOWS)
            logs = scorer.log_probabilities(given[part], wanted[part], scored[part])
            which = np.repeat(owner[part], scored[part].sum(axis=1))
            out[:] += np.bincount(which, weights=logs, minlength=len(texts))
        pending, owners, held = [], [], 0

    for i, classes in enumerate(texts):
        pending.append(am.windows_of(classes))
        owners.append(np.full(len(pending[-1][0]), i))
        held += len(pending[-1][0])
        if held >= 8 * SCORE_WINDOWS:
            run()
    if pending:
        run()
    return out


def _scoring(path: str, model):
    """(row, id, held_out, n_tokens, known, base, score, rare) of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        weights, vocabulary, top, end_log = model.value
        class_of, inside = vocabulary.class_of, vocabulary.inside
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                ids = batch.column(1).to_pylist()
                classes, plain, n_tokens, known, base = [], [], [], [], []
                rare_words, rare_counts, rare_ends = [], [], [0]
                for text in batch.column(2):
                    raw = text.as_py() or ""
                    words = raw.encode("utf-8", "replace").lower().split()
                    sub = np.frombuffer(encoder.encode_words(words) + END, "<u4")
                    classes.append(class_of[sub].astype("i8"))
                    plain.append(float(inside[sub].sum(dtype="f8")))
                    found = list(map(top.get, words))  # log shares: below zero, or None
                    missing = found.count(None)
                    n_tokens.append(len(words) + 1)
                    known.append(len(words) - missing + (end_log[1] > 0))
                    base.append(sum(filter(None, found)) + end_log[0])
                    if missing:
                        other = Counter(w for w, x in zip(words, found, strict=True) if x is None)
                        rare_words.extend(other.keys())
                        rare_counts.extend(other.values())
                    rare_ends.append(len(rare_words))
                score = (score_classes(weights, classes) + np.array(plain)) / math.log(10)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array([remainder(i) == HELD_OUT for i in ids]),
                        pa.array(n_tokens, pa.int64()),
                        pa.array(known, pa.int64()),
                        pa.array(base, pa.float64()),
                        pa.array(score, pa.float64()),
                        pa.ListArray.from_arrays(
                            pa.array(rare_ends, pa.int32()),
                            pa.StructArray.from_arrays(
                                [pa.array(rare_words, pa.binary()), pa.array(rare_counts, pa.int64())], ["word", "n"]
                            ),
                        ),
                    ],
                    names=["row", "id", "held_out", "n_tokens", "known", "base", "score", "rare"],
                )

    return run


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocabulary: str | None = None,
    rounds: int = ROUNDS, top_words: int = TOP_WORDS, worker_subwords: int = WORKER_SUBWORDS,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    spark = docs.sparkSession
    ship_package(spark)
    path = vocabulary or tokenizer_path()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    gathered = materialize(rows.mapInArrow(_gather(path), "word binary, n long, ids binary, deal long"), "lm-gathered")
    counts = materialize(
        gathered.filter("word is not null").groupBy("word").agg(F.sum("n").alias("c")), "lm-counts"
    )
    train_tokens, types = (int(x or 0) for x in counts.agg(F.sum("c"), F.count(F.lit(1))).first())
    base_of = math.log10(train_tokens + types + 1)

    texts = gathered.filter("ids is not null")
    subwords = (
        texts.select("ids").mapInArrow(_subword_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    )  # at most one row per subword of the tokenizer
    by_id = np.zeros(VOCABULARY_SIZE, "i8")
    by_id[subwords["id"].to_numpy("i8")] = subwords["n"].to_numpy("i8")
    classes = am.Vocabulary.from_counts(by_id, word_encoder(path).ends_word(VOCABULARY_SIZE))
    weights = train_model(texts, classes, int(by_id.sum()), int(by_id[END_ID]), rounds, worker_subwords)

    frequent = frequent_words(counts.filter(F.length("word") > 0), top_words).toPandas()
    top = {bytes(w): math.log10(c + 1) - base_of for w, c in zip(frequent["word"], frequent["c"], strict=True)}
    del frequent
    ends = counts.filter(F.length("word") == 0).select("c").first()
    n_ends = int(ends.c) if ends else 0
    model = spark.sparkContext.broadcast((weights, classes, top, (math.log10(n_ends + 1) - base_of, n_ends)))

    scored = materialize(
        rows.select(F.monotonically_increasing_id().alias("row"), "id", "text").mapInArrow(
            _scoring(path, model),
            "row long, id long, held_out boolean, n_tokens long, known long, base double, score double, "
            "rare array<struct<word:binary,n:long>>",
        ),
        "lm-scored",
    )
    rare = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n")
    each = F.log10(F.coalesce("c", F.lit(0)) + 1) - base_of
    rest = (
        rare.join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("n") * each).alias("rare_base"),
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
        )
    )
    return scored.join(rest, "row", "left").select(
        F.col("id").alias("doc_id"),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        "score",
    )


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"))
