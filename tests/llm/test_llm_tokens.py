import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tripflow.llm import packed, tokens


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_tokenizer())


@given(st.lists(st.integers(0, 2**32 - 1), max_size=30), st.integers(0, 2**32 - 1), st.integers(0, 3000))
@settings(max_examples=60, deadline=None)
def test_blocks_round_trip(odd, base, n):
    ids = np.concatenate([odd, (base + np.arange(n) % 17) % 2**32]).astype(np.uint32)
    blocks = packed.pack_blocks(ids)
    assert len(blocks) == -(-len(ids) // packed.BLOCK)
    found = [packed.unpack_block(b, 0) for b in blocks]
    assert np.array_equal(np.concatenate(found) if found else [], ids)


def test_outliers_dont_widen_a_block():
    ids = np.arange(packed.BLOCK, dtype=np.uint32) % 16 + 1000
    ids[5], ids[700] = 2**32 - 1, 50_000
    (block,) = packed.pack_blocks(ids)
    least, n, exceptions, width = struct.unpack_from(packed.BLOCK_HEADER, block)
    assert (least, n, exceptions, width) == (1000, 1024, 2, 4)
    assert len(block) == struct.calcsize(packed.BLOCK_HEADER) + 1024 * 4 // 8 + 2 * 6
    assert np.array_equal(packed.unpack_block(block, 0), ids)


def test_any_range_of_a_file_without_the_rest():
    ids = np.random.default_rng(3).integers(0, 50_257, 10_000).astype(np.uint32)
    image = packed.file_image(4, 2, ids, [7, None, -1], [4000, 0, 6000])
    file = packed.TokenFile(image)
    assert (file.part, file.number, file.doc_ids, list(file.counts)) == (4, 2, [7, None, -1], [4000, 0, 6000])
    for first, stop in [(0, 0), (0, 1), (1023, 1025), (5000, 9999), (9999, 10_000), (0, 20_000), (12_000, 13_000)]:
        assert np.array_equal(file.ids(first, stop), ids[first:stop])
    damaged = bytearray(image)
    damaged[struct.calcsize(packed.HEADER) : int(file.starts[3])] = bytes(int(file.starts[3]) - struct.calcsize(packed.HEADER))
    assert np.array_equal(packed.TokenFile(bytes(damaged)).ids(3 * 1024, 4000), ids[3 * 1024 : 4000])
    with pytest.raises(ValueError):
        packed.TokenFile(image[:-1])


ODD = ["", " ", "  two  spaces ", "a\nb", "a\n\nb\n", "it's Bob's, o.k.?!", "×.÷, é. Ünder; ",
       " x　y z\u0085q", "一二三。 四五", "tab\tand\r\nline", "<|endoftext|> x<|endoftext|>.", "1.5, 2,000: ok",
       "\U0001f600. é\n×\n÷ .", "x" * 300, "\x00\x01 a.", "é. ́, a​ b", "_. -, (a), [b]; <|", "."]


def direct(tokenizer, texts):
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


@given(st.lists(st.text(st.sampled_from("ab1é×÷ \n\t.,!?'s 　 ́文<|>"), max_size=40), max_size=8))
@settings(max_examples=40, deadline=None)
def test_pieces_give_the_ids_of_whole_texts(tokenizer, texts):
    import pyarrow as pa

    flat, counts = tokens.Encoder(tokens.default_tokenizer()).ids(pa.array(texts + ODD, pa.large_string()), 0)
    want = direct(tokenizer, texts + ODD)
    assert list(counts) == [len(w) for w in want]
    assert flat.tolist() == [i for w in want for i in w]


def test_remembered_pieces_are_bounded(monkeypatch, tokenizer):
    import pyarrow as pa

    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    encoder = tokens.Encoder(tokens.default_tokenizer())
    for k in range(6):
        texts = [f"word{i} and{i}, more" for i in range(k * 10, k * 10 + 15 + 30 * (k == 4))]
        flat, counts = encoder.ids(pa.array(texts, pa.large_string()), None)
        assert flat.tolist() == [i for t in texts for i in tokenizer.encode(t, add_special_tokens=False).ids]
        assert k == 4 or len(encoder.known) <= 50


@given(st.lists(st.text(st.sampled_from("abé1#$%&*'( \n\t.ÿД文|"), max_size=40), max_size=8))
@settings(max_examples=40, deadline=None)
def test_words_beside_marks_give_the_ids_of_whole_texts(tokenizer, texts):
    import pyarrow as pa

    texts = [*texts, "word### 5% a&b $$$x c*d'l é$ ÿ&&& ×% Word", "a", " a", "é", ""]
    flat, counts = tokens.Encoder(tokens.default_tokenizer()).ids(pa.array(texts, pa.large_string()), 0)
    want = direct(tokenizer, texts)
    assert list(counts) == [len(w) for w in want]
    assert flat.tolist() == [i for w in want for i in w]


def test_a_new_word_is_encoded_without_the_steps_around_the_model(monkeypatch):
    import pyarrow as pa

    encoder, others = tokens.Encoder(tokens.default_tokenizer()), []

    class Counted:
        def __init__(self, tokenizer):
            self.model, self.tokenizer = tokenizer.model, tokenizer

        def encode_batch_fast(self, pieces, **options):
            others.extend(pieces)
            return self.tokenizer.encode_batch_fast(pieces, **options)

        def encode(self, piece, **options):
            others.append(piece)
            return self.tokenizer.encode(piece, **options)

    encoder.tokenizer = Counted(encoder.tokenizer)
    texts = ["Some words### and, Éclair$$$ more%%%\nLines 12 "] * 2
    encoder.ids(pa.array(texts, pa.large_string()), 0)
    assert sorted(others) == ["\n", " ", " 12", "###", "$$$", "%%%", ","]


def test_forgotten_pieces_are_those_a_text_does_not_hold(monkeypatch, tokenizer):
    import pyarrow as pa

    monkeypatch.setattr(tokens, "REMEMBERED", 12)
    encoder = tokens.Encoder(tokens.default_tokenizer())
    for text in ("kept one two three four five", "kept one six seven eight nine ten", "kept eleven twelve ten thirteen"):
        flat, _ = encoder.ids(pa.array([text], pa.large_string()), None)
        assert flat.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert {"kept", " ten", " thirteen"} <= set(encoder.known.to_pylist())
    assert len(encoder.known) <= 12


def test_a_tokenizer_with_other_steps_is_followed(tmp_path, tokenizer):
    import pyarrow as pa
    from tokenizers import AddedToken, Tokenizer

    other = Tokenizer.from_str(tokenizer.to_str())
    other.add_tokens([AddedToken("hello", normalized=False)])
    other.save(f"{tmp_path}/other.json")
    texts = ["hello there", "say hello, you", "other hellos"]
    flat, _ = tokens.Encoder(f"{tmp_path}/other.json").ids(pa.array(texts, pa.large_string()), None)
    assert flat.tolist() == [i for t in texts for i in other.encode(t, add_special_tokens=False).ids]


def test_files_end_behind_the_document_that_fills_them(spark, tmp_path, tokenizer):
    docs = spark.createDataFrame([(i, "a b c d") for i in range(50)], "doc_id long, text string").coalesce(1)
    tokens.write_tokens(docs, f"{tmp_path}/t", file_ids=12)
    found = tokens.read_tokens(spark, f"{tmp_path}/t").orderBy("number", "place").collect()
    assert [(r["doc_id"], r["number"], r["place"]) for r in found] == [(i, i // 3, i % 3) for i in range(50)]


def expected(tokenizer, rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for (d, t), ids in zip(rows, direct(tokenizer, [t for _, t in rows]), strict=True):
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_on_edge_cases(spark, tmp_path, tokenizer):
    texts = [*ODD, None, "long text, with words. " * 20_000]
    rows = [(i * 3 % 41 - 5, t) for i, t in enumerate(texts)] + [(100, "same")] * 200 + [(None, "no id")]
    extra = [(d, t, 1, "x") for d, t in rows]
    frame = spark.createDataFrame(extra, "doc_id long, text string, ids int, part string")
    frame.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted((tuple(r) for r in tokens.op11_token_blocks(spark, str(tmp_path)).collect()), key=lambda r: r[1])
    assert found == expected(tokenizer, rows)


def test_many_small_files_and_rows_of_one_id(spark, tmp_path, tokenizer):
    rows = [(i // 2, f"text {i}, é " * (i % 9)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    tokens.write_tokens(docs, f"{tmp_path}/t", part_bytes=4000, file_ids=100)
    found = tokens.read_tokens(spark, f"{tmp_path}/t").orderBy("part", "number", "place").collect()
    assert [r["doc_id"] for r in found] == sorted(d for d, _ in rows)
    assert len({(r["part"], r["number"]) for r in found}) > 20
    want = sorted((d, np.array(i, "<u4").tobytes()) for (d, _), i in zip(rows, direct(tokenizer, [t for _, t in rows])))
    assert sorted((r["doc_id"], bytes(r["ids"])) for r in found) == want


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert tokens.op11_token_blocks(spark, str(tmp_path)).collect() == []
