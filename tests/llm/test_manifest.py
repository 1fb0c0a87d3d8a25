"""Merkle manifest against a plain tree, and every proof folded again."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cohortlens.llm.manifest import fold, leaf_digest, prove, sweep_down, sweep_up
from cohortlens.llm.queries import op11_merkle_manifest


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _tree(digests):
    """(top, siblings of each leaf from the leaf up)."""
    paths = [[] for _ in digests]
    at, now = list(range(len(digests))), list(digests)
    while len(now) > 1:
        for i, place in enumerate(at):
            first = place // 8 * 8
            run = now[first : first + 8]
            paths[i].append((run[: place - first], run[place - first + 1 :]))
            at[i] = place // 8
        now = [_h("".join(now[i : i + 8])) for i in range(0, len(now), 8)]
    return now[0], paths


def _plain(rows):
    """{(doc_id, leaf): sorted results} of (doc_id, source, lang, n_chars, text)."""
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append((row, _h("".join(map(_field, row)))))
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        leaves = sorted(by_lang[lang], key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[lang] = (leaves, *_tree([d for _, d in leaves]))
    root, above = _tree([trees[lang][1] for lang in order])
    out = []
    for lang, over in zip(order, above):
        leaves, subroot, paths = trees[lang]
        for (row, leaf), path in zip(leaves, paths):
            proof, now = "", list(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                now[4] = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
            digest = _h("".join(map(_field, now)))
            for left, right in path + over:
                proof += "".join(left + right)
                digest = _h("".join(left) + digest + "".join(right))
            out.append((row[0], leaf, subroot, root, _h(proof), digest, digest == root))
    return sorted(out, key=repr)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, n long, size long, tree int, carry string, _at int"


def _rows():
    rng = random.Random(1)
    rows = [(i, "s", rng.choice(["a", "b", "é", None, "a" * 9, "hot", "hot", "hot"]), i, rng.choice("ABcd") * i) for i in range(300)]
    rows += [(None, None, None, None, None), (None, "", "", 0, ""), (5, "x", "hot", 1, "X"), (5, "x", "hot", 1, "X")]
    rows += [(5, "x", "hot", 2, "y"), (900, "s", "long", 1, "Long " * 60_000), (901, "s", "one", None, "É é A")]
    return rows


@pytest.mark.parametrize("count", [0, 1, 2, 9, 307])
def test_query_against_plain(frame, tmp_path, count):
    rows = _rows()[-count:] if count else []
    frame([(*r, 1, 2, 3, "c", 4) for r in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = op11_merkle_manifest(frame([], "x int").sparkSession, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == (_plain(rows) if rows else [])


def test_blocks_do_not_matter(frame):
    docs = frame([(*r, 1, 2, 3, "c", 4) for r in _rows()], SCHEMA)
    leaf = leaf_digest(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")))
    leaves = docs.withColumn("leaf", leaf).withColumn("claim", F.lit("0" * 64))
    sides = []
    for levels in (1, 2, 5):
        out = prove(leaves, levels=levels).collect()
        assert all(fold(r.carry.leaf, r.proof, r["shape"]) == r.root for r in out)
        assert all(fold("0" * 64, r.proof, r["shape"]) == r.folded != r.root for r in out)
        assert {r.carry.tree for r in out} == {3} and {r.carry["_at"] for r in out} == {4}
        sides.append(sorted((r.carry.leaf, r.proof) for r in out))
    assert sides[0] == sides[1] == sides[2]


def test_sweeps():
    for size in (1, 2, 8, 9, 64, 65, 513):
        digests = [_h(str(i)) for i in range(size)]
        levels = 0
        while 8**levels < size:
            levels += 1
        top, paths = _tree(digests)
        assert sweep_up(digests, levels)[0] == top
        down = dict(sweep_down(digests, levels, ("above", (1, 2))))
        for i, path in enumerate(paths):
            proof, shape = down[i]
            assert proof == "".join("".join(a + b) for a, b in path) + "above"
            assert shape[:-2] == tuple(x for a, b in path for x in (len(a), len(a) + len(b) + 1))


def test_a_hot_language_is_cut(frame):
    """Equal rows and one language: still many parts, and all proofs hold."""
    leaves = (
        frame([], "x int").sparkSession.range(20_000)
        .select(F.lit(1).alias("doc_id"), F.lit("en").alias("lang"), F.sha2(F.lit("a"), 256).alias("leaf"))
        .withColumn("claim", F.col("leaf"))
    )
    out = prove(leaves, levels=3)
    assert out.where("folded <> root").count() == 0 and out.agg(F.max("n")).first()[0] == 19_999
    assert out.select("n").distinct().count() == 20_000
