import numpy as np
import public_tokenizers

from support import docs, prose  # noqa: F401
from marketflow.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_equals_the_library_and_decodes(docs, monkeypatch):
    texts = ["  x  y\n\n z　q\xa0 r \x1c a\x85b", "it's I'LL  's<|endoftext|>  ", "日本語 ünï 1234ab", "", None, " ", prose(1, 9000), "the " * 5000]
    pairs = [*enumerate(texts), (None, "x"), (3, "again"), (3, "again")]
    monkeypatch.setattr(bpe, "TABLE_WORDS", 10)
    encoded = bpe.decode(bpe.encode(docs(pairs), PATH, public_tokenizers.PATTERN, buckets=7), PATH)
    core = bpe.core(PATH, public_tokenizers.PATTERN)
    got = sorted([(r["doc_id"], np.frombuffer(bytes(r["ids"]), "<u4").tolist(), bytes(r["decoded"])) for r in encoded.collect()], key=repr)
    assert got == sorted([(i, core.encode_ordinary(t or ""), (t or "").encode()) for i, t in pairs], key=repr)
    assert bpe.encode(docs([]), PATH, public_tokenizers.PATTERN).count() == 0


def test_long_runs_of_blanks(docs):
    run = " " * 5_000_000
    encoded = bpe.decode(bpe.encode(docs([(1, f"a{run}b"), (2, "\t" * 900_000)]), PATH, public_tokenizers.PATTERN), PATH)
    assert {r["doc_id"]: bytes(r["decoded"]) for r in encoded.collect()} == {1: f"a{run}b".encode(), 2: b"\t" * 900_000}


def test_numbers_survive_packing():
    for codes in (np.array([], np.uint32), np.array([0, 1, 70_000, 2**32 - 1], np.uint32)):
        assert bpe._unpacked(bpe._packed(codes), len(codes)).tolist() == codes.tolist()
