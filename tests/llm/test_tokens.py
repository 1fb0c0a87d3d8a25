"""Token counts against the tokenizer's own library."""

import os

import pytest
from tokenizers import Tokenizer

from cohortlens.llm.queries import TOKENIZERS, op8_token_counts
from cohortlens.llm.tokens import count_tokens

FILE = os.path.join(TOKENIZERS, "byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def _expected(tokenizer, text):
    return len(tokenizer.encode(text, add_special_tokens=False).ids) if text else 0


def test_edge_cases(frame, tokenizer):
    texts = [
        None, "", " ", "a<|endoftext|>b", "<|endoftext|><|endoftext|>", "  x \n\n y\t", "don't 'S",
        "日本語 text ①", "é     x\x1cy\x85z", "word " * 30_000, "Ab0" * 20_000, "a  ",
    ]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, "x y", 1), (1, "", 2)]
    got = count_tokens(frame(rows, "doc_id long, text string, n_tokens int"), FILE, limit=10)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = sorted(
        (str(i), len((t or "").encode()), n := _expected(tokenizer, t), n > 10) for i, t, _ in rows
    )
    assert sorted((str(r.doc_id), *r[1:]) for r in got.collect()) == want


def test_empty_table(frame):
    assert count_tokens(frame([], "doc_id long, text string"), FILE).collect() == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_files(frame, name):
    path = os.path.join(TOKENIZERS, name)
    got = count_tokens(frame([(1, "Some plain words, twice."), (2, None)], "doc_id int, text string"), path)
    counts = {r.doc_id: r.n_tokens for r in got.collect()}
    assert counts[2] == 0 and 4 <= counts[1] <= 12


def test_whole_table(spark, folder, tokenizer):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: _expected(tokenizer, r.text) for r in docs}
    assert {r.doc_id: r.n_tokens for r in op8_token_counts(spark, folder).collect()} == want
