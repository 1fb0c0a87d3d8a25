"""Token counts by a two-tier lookup on the map side.

Most pre-tokens of a corpus are few and frequent. Their lengths are encoded
once and broadcast as a table of bounded size; what it lacks is encoded by the
tokenizer's own library and kept in a cache of the task. No pre-token is shuffled.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import slices

#: Rows looked at to pick the frequent pre-tokens, and how much of each; this steers speed,
#: never a count: counting always sees whole texts.
SAMPLE_ROWS, SAMPLE_CHARS = 1_000, 16_384
TABLE_ENTRIES = 65_536
ENTRY_CHARS = 48
CACHE_ENTRIES = 400_000

#: Fixed value: the pre-token pattern that byte-level BPE files leave to their library.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters on whose class all regular expression libraries agree; texts with others
#: are encoded whole by the tokenizer's library.
SETTLED = r"[\x00-\x1B\x20-\x84\x86-ɏ‐-‧‰-⁞]*"


class _Lengths(dict):
    """Token count by pre-token: the broadcast entries, then what this task encodes."""

    def __init__(self, frequent: dict[str, int], encode) -> None:
        super().__init__(frequent)
        self.frequent = frequent
        self.encode = encode

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(piece, add_special_tokens=False).ids)
        if len(piece) <= ENTRY_CHARS:
            if len(self) >= TABLE_ENTRIES + CACHE_ENTRIES:
                self.clear()
                self.update(self.frequent)
            self[piece] = n
        return n


def _plain_byte_level(spec: dict) -> bool:
    """Whether whole texts may be cut by PRE_TOKEN: nothing but byte-level BPE is set."""
    cut = spec.get("pre_tokenizer") or {}
    return (
        cut.get("type") == "ByteLevel"
        and cut.get("use_regex", True)
        and not cut.get("add_prefix_space", True)
        and not spec.get("normalizer")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"])
    )


def _load(spec_text: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(spec_text)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _cut(text: str, pattern, added) -> tuple[int, list[str]]:
    """Number of added tokens written out in ``text``, and the pre-tokens between them."""
    if added is None:
        return 0, pattern.findall(text)
    segments = added.split(text)
    return len(segments) - 1, [p for s in segments for p in pattern.findall(s)]


def _added_pattern(spec: dict):
    names = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
    return regex.compile("|".join(map(regex.escape, names))) if names else None


def _frequent(docs: DataFrame, spec_text: str) -> dict[str, int]:
    """Lengths of the most frequent short pre-tokens of a few rows; at most TABLE_ENTRIES.

    ``take`` reads only as many partitions as it needs, and the sampled text is
    bounded. Whatever it misses is encoded where it occurs.
    """
    pattern, added = regex.compile(PRE_TOKEN), _added_pattern(json.loads(spec_text))
    seen: Counter = Counter()
    for (text,) in docs.select(F.substring("text", 1, SAMPLE_CHARS)).take(SAMPLE_ROWS):
        seen.update(p for p in _cut(text or "", pattern, added)[1] if len(p) <= ENTRY_CHARS)
    encode = _load(spec_text).encode
    return {
        p: len(encode(p, add_special_tokens=False).ids) for p, _ in seen.most_common(TABLE_ENTRIES)
    }


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_bytes, n_tokens and over_limit (n_tokens > limit).

    Counts are those of the library the file belongs to, over the whole text,
    without begin, end or added special tokens; special strings in a text are
    treated as the library does by default. Null and empty texts have 0 tokens;
    repeated rows are counted each; other columns are ignored; a null id is kept.
    An empty table gives an empty result. The file (a few MB) travels as a
    broadcast, so ``tokenizer_path`` need exist on the driver only.
    """
    spark = docs.sparkSession
    if tokenizer_path.endswith(".model"):
        with open(tokenizer_path, "rb") as f:
            shared = spark.sparkContext.broadcast(("model", f.read(), {}))
    else:
        with open(tokenizer_path, encoding="utf-8") as f:
            text = f.read()
        if _plain_byte_level(json.loads(text)):
            shared = spark.sparkContext.broadcast(("bytes", text, _frequent(docs, text)))
        else:
            shared = spark.sparkContext.broadcast(("json", text, {}))

    def counter():
        kind, file, frequent = shared.value
        if kind == "model":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=file)
            return lambda text: len(model.encode(text))
        tokenizer = _load(file)
        whole = lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)
        if kind == "json":
            return whole
        pattern, settled = regex.compile(PRE_TOKEN), regex.compile(SETTLED)
        added = _added_pattern(json.loads(file))
        length = _Lengths(frequent, tokenizer.encode).__getitem__

        def count(text: str) -> int:
            if not settled.fullmatch(text):
                return whole(text)
            n, pieces = _cut(text, pattern, added)
            return n + sum(map(length, pieces))

        return count

    def count_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter()
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode()) if t else 0 for t in texts], pa.int64()),
                    pa.array([count(t) if t else 0 for t in texts], pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "text").mapInArrow(
        count_batches, f"doc_id {id_type}, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
