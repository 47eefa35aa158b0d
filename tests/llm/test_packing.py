import random
import struct
import zlib
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from odometrix.llm.packing import best_fit, local_search, pack_documents, pack_group
from odometrix.llm.subwords import WordEncoder, tokenizer_path
from tests.llm.helpers import documents, hard_rows

ENCODER = WordEncoder(tokenizer_path(), max_words=500)
UNALTERED = Tokenizer.from_file(tokenizer_path())


def direct(text):
    ids = ENCODER.tokenizer.encode(text, add_special_tokens=False).ids
    return struct.pack(f"<{len(ids)}I", *ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abcXYZ's019.,-_!?#<|>éÉİΣσςß٣ \t\n \u0085　́한🙂\x00\x1c")), max_size=60))
def test_cached_ids_are_the_tokenizers(text):
    assert ENCODER.encode(text) == direct(text)


def test_special_strings_are_the_tokenizers_own_tokens():
    for text in (
        "a <|endoftext|> b", "<|endoftext|>", "x<|startoftext|>y <|ENDOFTEXT|> z", "<|END <|endoftext|", "no such thing",
        "Ünder <|endoftext|><|endoftext|>\n\t" + "long " * 5000, "",
    ):
        ids = UNALTERED.encode(text, add_special_tokens=False).ids
        assert ENCODER.encode_text(text) == struct.pack(f"<{len(ids)}I", *ids)
    assert struct.unpack("<3I", ENCODER.encode_text("a <|endoftext|> b")) == (320, 49407, 321)


def test_ids_of_the_tables(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    for r in rows:
        assert ENCODER.encode(r.text or "") == direct(r.text or "")
    for text in ("<|endoftext|> don't we're", "x²½ ǅabc straße. ﬁ", "Ὀδυσσεύς ΌΔΟΣ"):
        assert ENCODER.encode(text) == direct(text)


def test_pieces_and_places(spark):
    rows = hard_rows()
    got = pack_documents(documents(spark, rows), capacity=256).collect()
    want = []
    for i, t, _ in rows:
        ids = direct(t or "") + b"\0\0\0\0"
        for k, at in enumerate(range(0, len(ids), 1024)):
            part = ids[at : at + 1024]
            want.append((str(i), k, at // 4, len(part) // 4, zlib.crc32(part)))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(bins) <= -(-sum(r.length for r in got) // 256) + 1


def test_local_search_beats_best_fit():
    r = random.Random(3)
    lengths = [r.randint(500, 1100) for _ in range(400)]
    first = best_fit(lengths, 2048)
    n = len(first)
    best = local_search(first, lengths, 2048)
    assert len(best) < n
    assert sorted(i for b in best for i in b) == list(range(400))
    assert all(sum(lengths[i] for i in b) <= 2048 for b in best)


def test_exchange_empties_a_bin():
    # Best fit needs three bins; one exchange brings it to two.
    assert len(pack_group([6, 5, 5, 4], 10)) == 2
    assert len(local_search([[0, 2], [1], [3]], [4, 7, 3, 6], 10)) == 2


def test_empty_table(spark):
    assert pack_documents(documents(spark, hard_rows()).limit(0)).count() == 0


def test_search_leaves_no_helpful_change_in_any_bin():
    r = random.Random(5)
    lengths = [r.randint(550, 1000) for _ in range(1500)]
    bins = pack_group(lengths, 2048)
    fill = [sum(lengths[i] for i in b) for b in bins]
    assert sum(f < 2048 for f in fill) > 200 and len(bins) > -(-sum(lengths) // 2048)
    sizes = [[0, *(lengths[i] for i in b)] for b in bins]
    sizes_two = [{x + y for k, x in enumerate(s) for y in s[:k]} for s in sizes]
    for p in range(len(bins)):
        for q in range(len(bins)):
            if p == q or 2048 in (fill[p], fill[q]):
                continue
            for coming in sizes_two[q]:
                for out in sizes[p]:
                    delta = coming - out
                    assert delta <= 0 or fill[p] + delta > 2048 or fill[p] - fill[q] + delta <= 0


def test_search_offers_small_items_of_full_bins():
    # Only the smallest of 67 items fits the second bin; without it the third bin's item fits the first.
    lengths = [5] * 66 + [2, 368, 40]
    bins = local_search([list(range(67)), [67], [68]], lengths, 370)
    assert [sum(lengths[i] for i in b) for b in bins] == [370, 370]
    assert sorted(i for b in bins for i in b) == list(range(69))
