import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillwright.llm import packing, token_orc
from tillwright.llm.queries import QUERIES
from tillwright.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"
TEXTS = [
    "", " ", "\n", "a", "  two  spaces ", "a\xa0 b", "x   y", "a\x1cb!\x1c!", "I'S <|ENDOFTEXT|> don't\n\n x", "x<|endoftext|> y", "<|startoftext|>",
    "ΑΣ ΟΔΟΣ, É́ 1234 foo,bar!! x.", "日本 語　x", "we'll 'll a,b .c,", "été élan. ß× ÷ü", "ﬁ ǅ ŉ İ", "a" * 5000, "wörter-mit-strich, und?! mehr: ja; nein.",
]


@pytest.mark.parametrize(("name", "lower"), [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_pieces_give_the_ids_of_whole_texts(name, lower, spark):
    encoder, plain = Encoder(public_tokenizers.path(name), lower), Tokenizer.from_file(public_tokenizers.path(name))
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()] + [None]
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert ids.tolist() == plain.encode(text or "", add_special_tokens=False).ids, text


def plain_ids(docs, name, end):
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    return [(i, [*plain.encode(t or "", add_special_tokens=False).ids, end]) for i, t in docs]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_token_orc_reads_back_what_was_encoded(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    want, start = {}, 0
    for i, ids in plain_ids(docs, "word_bpe_49k.json", 2):
        want[i] = (start, len(ids), crc(ids))
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op2_token_orc"](spark, SF).collect()}
    assert got == want


def test_token_orc_odd_rows_order_and_pruning(spark, odd, nothing, tmp_path):
    path = str(tmp_path / "t")
    token_orc.write_token_orc(odd, path, public_tokenizers.path("word_bpe_49k.json"), 2, lower=True)
    rows = sorted(token_orc.document_index(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 1, 2, 3, 4, 5, 6, 7, 8]
    assert all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:])) and rows[0].start == 0
    assert {r.doc_id for r in rows if r.n_tokens == 1} == {2, 3, 4}
    one = token_orc.read_token_orc(spark, path).filter("doc_id = 5")
    assert one.count() == 1 and "doc_id,5" in one._jdf.queryExecution().toString().replace(" ", "")
    token_orc.write_token_orc(nothing, str(tmp_path / "e"), public_tokenizers.path("word_bpe_49k.json"), 2, lower=True)
    assert token_orc.document_index(spark, str(tmp_path / "e")).count() == 0


def check_packing(rows, docs, size):
    """Every piece once, gapless, no sequence overfull; pieces hold the documents' ids."""
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append(r)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= size
    for i, ids in docs:
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts))) and all(r.length == size for r in parts[1:])
        assert len(parts) == -(-len(ids) // size)
        for r in parts:
            assert r.ids_crc32 == crc(ids[r.start : r.start + r.length])
        assert sum(r.length for r in parts) == len(ids)
    return len(by_sequence)


def test_pack_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    ids = plain_ids(docs, "byte_bpe_50k.json", 0)
    used = check_packing(QUERIES["op4_pack"](spark, SF).collect(), ids, 2048)
    assert used <= 1.02 * -(-sum(len(x) for _, x in ids) // 2048) + 1


def test_pack_odd_rows_and_sequences(odd, nothing):
    unique = odd.filter("doc_id <> 1 or doc_id is null")
    made = packing.pieces(unique, public_tokenizers.path("byte_bpe_50k.json"), 0, 64, with_ids=True)
    packed = packing.pack(made, 64, shard_pieces=3)
    ids = plain_ids([(r.doc_id, r.text) for r in unique.collect()], "byte_bpe_50k.json", 0)
    check_packing(packed.collect(), ids, 64)
    whole = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in whole) == sum(len(x) for _, x in ids)
    assert all(r.offsets[0] == 0 and len(r.ids) <= 64 for r in whole)
    made = packing.pieces(odd, public_tokenizers.path("byte_bpe_50k.json"), 0)
    assert packing.pack(made).filter("doc_id = 1").count() == 2
    assert packing.pack(packing.pieces(nothing, public_tokenizers.path("byte_bpe_50k.json"), 0)).count() == 0


def test_places_minimise_the_sum_of_squares():
    rng = np.random.default_rng(4)
    lengths = np.sort(rng.integers(1, 51, 300))[::-1]
    sequence, offset = packing.sum_of_squares(lengths, 50)
    gaps = {}
    for n, s, o in zip(lengths.tolist(), sequence.tolist(), offset.tolist()):
        count = lambda g: np.bincount(list(g.values()), minlength=51)[1:]
        fits = {}
        for b, g in gaps.items():
            if g >= n and g not in fits:
                fits[g] = int((count(gaps | {b: g - n}) ** 2).sum())
        if fits:
            g = gaps[s]
            assert (fits[g], g) == min((v, k) for k, v in fits.items())
        else:
            assert s not in gaps
        assert o == 50 - gaps.get(s, 50)
        gaps[s] = gaps.get(s, 50) - n


@pytest.mark.parametrize(("n", "want"), [(1, [0, 1]), (8, [0, 8]), (9, [0, 1, 9]), (16, [0, 8, 16]), (20, [0, 4, 12, 20])])
def test_cuts(n, want):
    assert packing.cuts(n, 8) == want


def test_shards_follow_pieces_and_spread_equal_rows(spark):
    """One long document, and equal rows without an id that are a third of all."""
    rows = [(None, "same words here")] * 400 + [(k, f"text {k} " * 5) for k in range(700)] + [(9999, "long text " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    made = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), 0, 64)
    packed = packing.pack(made, 64, shard_pieces=100)
    shard = (packed["sequence_id"] / (1 << 40)).cast("int")
    sizes = [r["count"] for r in packed.groupBy(shard.alias("s")).count().collect()]
    assert len(sizes) >= 15 and max(sizes) < 200
    equal = [r["count"] for r in packed.filter("doc_id is null").groupBy(shard.alias("s")).count().collect()]
    assert len(equal) >= 10 and sum(equal) == 400
    rows_ = packed.orderBy("sequence_id", "offset").collect()
    assert sum(r.length for r in rows_) == made.agg({"length": "sum"}).first()[0]
    for a, b in zip(rows_, rows_[1:]):
        assert b.offset == (a.offset + a.length if a.sequence_id == b.sequence_id else 0) and b.offset + b.length <= 64


@pytest.mark.parametrize("kept", [0, 5_000])
def test_a_small_memory_of_pieces_gives_the_same_ids(kept):
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, plain = Encoder(path, False, kept), Tokenizer.from_file(path)
    for k in range(30):
        texts = [f"word{j * k} some more, and {j}!" for j in range(40)]
        assert [i.tolist() for i in encoder.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert encoder.held <= kept + 40 * 8 * 300


@pytest.mark.parametrize("name,lower", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_a_mark_after_a_letter_is_a_piece_of_its_own(name, lower):
    """So a word is encoded and kept once, not once more with each mark."""
    encoder = Encoder(public_tokenizers.path(name), lower)
    texts = ["one two, two. two! 3rd, 3rd; don't, don't. été, té! x×, 7, a... b?! ,", ",", "a,", "é,", "×,", "7.", " ,", "a\n,", "a ", ""]
    for some in [texts, *([t] for t in texts)]:
        assert [x.tolist() for x in encoder.encode(some)] == [encoder.whole(t).tolist() for t in some]
    kept = set(encoder.young)
    assert {b" two", b" 3rd", b" don't", b" x\xc3\x97,", b" 7,", b" a...", b","} <= kept
    assert not kept & {b" two,", b" two.", b" two!", b" 3rd,", b" don't,", " été,".encode(), b"a,"}
