import hashlib
import random
import struct

import pytest
import sentencepiece

from shelfmark.llm import pieces
from shelfmark.llm.queries import QUERIES, tokenizer_path

DOCS = "doc_id long, text string"
PARTS = ["a", "the", " ", "  ", "▁", "\n", "\t", "é", "日", "😀", "\0", "<0x41>", "</s>", "<unk>", "ing", " " * 30, "x" * 30,
         " ", "ﬁ", "Ⅷ", "​", "�", "é"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())


@pytest.fixture(scope="module")
def codec():
    return pieces.Codec(pieces.Model.from_file(tokenizer_path()))


def some_texts(n, seed=0):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_ids_and_decoding_equal_the_library(codec, library):
    for text in ["", *some_texts(3000), "long " * 50000, "unbroken" * 20000]:
        ids, spans = codec.encode(text)
        assert ids == library.encode(text, add_eos=True)
        assert codec.decode(ids) == library.decode(ids)
        assert len(spans) == len(ids)
    rng = random.Random(1)
    for _ in range(2000):
        ids = [rng.randrange(32000 if rng.random() < 0.5 else 300) for _ in range(rng.randrange(12))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_spans_tile_the_source(codec):
    for text in some_texts(500, 2):
        data = text.encode()
        ids, spans = codec.encode(text)
        assert spans[-1] == (len(data), len(data))
        at = 0
        for i, (start, end) in zip(ids[:-1], spans):
            byte = i not in codec.model.plain
            assert start == at or (byte and end == at), (text, spans)
            at = max(at, end)
            if not byte and end > start:
                piece = codec.model.surfaces[i].decode()
                source = data[start:end].decode().replace("▁", " ")
                assert source in (piece, piece[1:])
        assert at == len(data)


def compiled(table):
    """A character map: a double-array trie over ``{prefix: replacement}``, built naively."""
    texts, at = b"", {}
    for prefix, new in table.items():
        at[prefix.encode()] = len(texts)
        texts += new.encode() + b"\0"
    units = [0] * (1 << 16)
    used = {0}

    def place(prefix, index):
        children = sorted({k[len(prefix)] for k in at if k.startswith(prefix) and len(k) > len(prefix)})
        labels = ([0] if prefix in at else []) + children
        offset = next(o for o in range(1, 1 << 15) if all(
            index ^ o ^ c not in used and index ^ o ^ c < len(units) for c in labels) and index ^ o not in used
            or (prefix in at and all(index ^ o ^ c not in used for c in labels)))
        units[index] |= offset << 10 | (prefix in at) << 8
        base = index ^ offset
        used.update(base ^ c for c in labels)
        if prefix in at:
            units[base] = at[prefix] | 1 << 31
        for c in children:
            units[base ^ c] = c
        for c in children:
            place(prefix + bytes([c]), base ^ c)

    place(b"", 0)
    blob = struct.pack(f"<{len(units)}I", *units)
    return struct.pack("<I", len(blob)) + blob + texts


TABLE = {"ﬁ": "fi", "Ⅷ": "VIII", "é": "é", "éx": "EX", " ": " ", "\t": " ", "​": "", "é": "é", "a": "a"}


@pytest.mark.parametrize("trim", [False, True])
def test_longest_prefix_map_equals_the_library(tmp_path, trim):
    from sentencepiece import sentencepiece_model_pb2 as files

    proto = files.ModelProto()
    with open(tokenizer_path(), "rb") as file:
        proto.ParseFromString(file.read())
    proto.normalizer_spec.precompiled_charsmap = compiled(TABLE)
    proto.normalizer_spec.remove_extra_whitespaces = trim
    path = tmp_path / "mapped.model"
    path.write_bytes(proto.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    codec = pieces.Codec(pieces.Model.from_file(str(path)))
    for text in [*some_texts(1500, 3), "éx ﬁ", "   ", "​", " a \t b "]:
        if "▁" in text and trim:
            continue
        ids, spans = codec.encode(text)
        assert ids == library.encode(text, add_eos=True), text
        assert all(0 <= a <= b <= len(text.encode()) for a, b in spans)
        assert [a for a, _ in spans] == sorted(a for a, _ in spans)
    ids, spans = codec.encode("xﬁ éxy")
    data = "xﬁ éxy".encode()
    covered = {data[a:b].decode() for a, b in spans}
    assert any("ﬁ" in c for c in covered) and any("éx" in c for c in covered)


def test_query_over_whole_documents(spark, library):
    folder = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op3_sentencepiece"](spark, folder).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r["doc_id"]] or "", add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert r["covered"] == len(docs[r["doc_id"]].encode())


def test_edge_cases(spark, codec):
    rows = [(1, None), (2, ""), (3, "same"), (3, "same"), (None, "é" * 200000)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'mine' as ids", "1 as Spans", "2 as other")
    got = pieces.with_pieces(docs, codec.model)
    assert got.columns == ["doc_id", "text", "other", "ids", "spans", "decoded"]
    out = got.collect()
    assert out[0]["ids"] == out[1]["ids"] == [2] and out[0]["decoded"] == ""
    assert out[2] == out[3] and out[4]["decoded"] == rows[4][1]
    assert pieces.with_pieces(docs.where("false"), codec.model).count() == 0
    assert pieces.digests(docs.where("false"), codec.model).count() == 0
