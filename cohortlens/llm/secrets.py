"""Secret scans with corpus-wide ownership frequency, in built-in expressions only.

Patterns propose spans. The hash of each proposed value is counted by distinct
owners and repositories over the whole corpus. A repository is a distinct text, so
copies of one document count once, whoever holds them. A value that is widely copied is
an example, any other looks live. Pattern spans are always reported; opaque mixed
strings become spans only while they look live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.session import cut_lineage


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


#: The base patterns. Runs of hex digits and of access keys are maximal, so
#: their least length can stand in the pattern; an assigned value is measured afterwards.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = (
    "(?:" + "|".join(map(_either_case, KEYWORDS)) + r""")["']?\x20*[:=]\x20*["']?"""
    r"([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
LEAST_ASSIGNED = 12
#: What the method adds: long strings that mix lower case, upper case and digits.
OPAQUE = "[A-Za-z0-9+/_-]{20,}"

#: A value is widely copied if it stands in more texts, and with more owners, than
#: MOST_OWNERS, or in more than MOST_TEXTS whoever owns them.
MOST_OWNERS, MOST_TEXTS = 2, 20

KINDS = ("assign", "access", "hex", "owned")
SPAN = "struct<start:int,rank:int,end:int,kind:string,hash:string>"
NONE = f"cast(array() as array<{SPAN}>)"


def _spans(matches: Column, values: Column, gaps: Column, kind: str) -> Column:
    """Places of ``matches``: the lengths of the text between them, summed up."""
    rank = KINDS.index(kind)
    out = F.aggregate(
        F.sequence(F.lit(1), F.size(matches)),
        F.struct(F.lit(0).alias("at"), F.expr(NONE).alias("out")),
        lambda acc, i: F.struct(
            (
                acc["at"]
                + F.length(F.element_at(gaps, i))
                + F.length(F.element_at(matches, i))
            ).alias("at"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        (acc["at"] + F.length(F.element_at(gaps, i))).alias("start"),
                        F.lit(rank).alias("rank"),
                        (
                            acc["at"]
                            + F.length(F.element_at(gaps, i))
                            + F.length(F.element_at(matches, i))
                        ).alias("end"),
                        F.lit(kind).alias("kind"),
                        F.md5(F.element_at(values, i)).alias("hash"),
                    )
                ),
            ).alias("out"),
        ),
    )["out"]
    return F.when(F.size(matches) > 0, out).otherwise(F.expr(NONE))


def _found(df: DataFrame, kind: str, pattern: str, group: int = 0) -> DataFrame:
    """Adds the array column ``kind``; texts without a match cost one search."""
    hit, gap, value = f"_{kind}_hit", f"_{kind}_gap", f"_{kind}_value"
    some = F.size(hit) > 0
    df = df.withColumn(hit, F.regexp_extract_all("_text", F.lit(pattern), 0))
    df = df.withColumn(gap, F.when(some, F.split("_text", pattern)))
    if group:
        df = df.withColumn(
            value, F.when(some, F.regexp_extract_all("_text", F.lit(pattern), group))
        )
    spans = _spans(F.col(hit), F.col(value if group else hit), F.col(gap), kind)
    if group:
        spans = F.filter(
            F.transform(
                spans,
                lambda s, i: F.struct(s.alias("s"), F.element_at(value, i + 1).alias("v")),
            ),
            lambda x: F.length(x["v"]) >= LEAST_ASSIGNED,
        )
        spans = F.transform(spans, lambda x: x["s"])
    return df.withColumn(kind, spans).drop(hit, gap, value)


def proposed(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``base`` and ``opaque``: arrays of spans in order of start."""
    df = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    df = _found(df, "assign", ASSIGN, 1)
    df = _found(df, "access", ACCESS)
    df = _found(df, "hex", HEX)
    # mixed strings are rare: a text without any is not cut
    mixed = F.regexp_extract_all("_text", F.lit(OPAQUE), 0)
    mixed = F.filter(
        mixed, lambda m: m.rlike("[a-z]") & m.rlike("[A-Z]") & m.rlike("[0-9]")
    )
    df = df.withColumn("_mixed", F.array_distinct(mixed))
    df = df.withColumn("_cut", F.when(F.size("_mixed") > 0, F.col("_text")).otherwise(""))
    hit, gap = F.regexp_extract_all("_cut", F.lit(OPAQUE), 0), F.split("_cut", OPAQUE)
    df = df.withColumn("_hit", hit).withColumn("_gap", gap)
    df = df.withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))
    spans = F.filter(
        F.transform(
            _spans(F.col("_hit"), F.col("_hit"), F.col("_gap"), "owned"),
            lambda s, i: F.struct(s.alias("s"), F.element_at("_hit", i + 1).alias("v")),
        ),
        lambda x: F.array_contains("_mixed", x["v"])
        & ~F.exists(
            "base", lambda b: (b["start"] < x["s"]["end"]) & (x["s"]["start"] < b["end"])
        ),
    )
    df = df.withColumn("opaque", F.transform(spans, lambda x: x["s"]))
    return df.drop("_text", "assign", "access", "hex", "_mixed", "_cut", "_hit", "_gap")


def ownership(spans: DataFrame) -> DataFrame:
    """(hash, n_owners, n_texts) from rows (hash, owner, repository).

    Pairs of value and owner, and of value and repository, are folded before the
    shuffle, so neither a much copied value nor a large owner gathers in a task.
    A null owner counts as one owner of its own.
    """
    owner = F.concat(F.lit("owner"), F.coalesce(F.concat(F.lit(":"), "owner"), F.lit("")))
    return (
        spans.select("hash", F.explode(F.array(owner, "repository")).alias("holder"))
        .distinct()
        .groupBy("hash")
        .agg(
            F.count_if(F.col("holder").startswith("owner")).alias("n_owners"),
            F.count_if(~F.col("holder").startswith("owner")).alias("n_texts"),
        )
    )


def _judged(rows: DataFrame, most_owners: int, most_texts: int) -> DataFrame:
    """(rid, spans): reported spans of a written table (rid, repository, owner, base, opaque)."""
    each = rows.select(
        "rid", "repository", "owner", F.explode(F.concat("base", "opaque")).alias("s")
    ).select("rid", "repository", "owner", "s", F.col("s.hash").alias("hash"))
    spread = (F.col("n_owners") > most_owners) & (F.col("n_texts") > most_owners)
    live = ~(spread | (F.col("n_texts") > most_texts))
    span = F.struct(
        "s.start", "s.rank", "s.end", "s.kind", "hash", "n_owners", "n_texts", live.alias("live")
    )
    return (
        each.join(ownership(each), "hash")
        .where((F.col("s.kind") != "owned") | live)
        .groupBy("rid")
        .agg(F.array_sort(F.collect_list(span)).alias("spans"))
    )


def _repository() -> Column:
    """A digest of the text; only texts with candidates need one. Digests hold no letter o."""
    return F.when(F.size("base") + F.size("opaque") > 0, F.md5(F.coalesce("text", F.lit(""))))


def find_secrets(
    docs: DataFrame,
    owner: str = "source",
    most_owners: int = MOST_OWNERS,
    most_texts: int = MOST_TEXTS,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, owner): doc_id and ``spans``.

    A span has start, end (code points, end exclusive), kind, the value's hash,
    n_owners and n_texts that carry the value, and ``live``: not widely copied, which is
    more than ``most_owners`` of both, or more than ``most_texts`` texts. Spans are ordered
    by start, then kind as in KINDS; a value at a threshold itself is live. Null and
    empty texts have none, very long ones are scanned whole; repeated rows, and copies of
    a text under any id or owner, are returned each and count as one text; a null owner
    is an owner. Other columns are ignored; an empty table gives an empty result.
    """
    rows = cut_lineage(
        proposed(docs.select("doc_id", F.col(owner).alias("owner"), "text"))
        .withColumn("repository", _repository())
        .drop("text")
        .withColumn("rid", F.monotonically_increasing_id())
    )
    judged = _judged(rows, most_owners, most_texts)
    none = F.expr("array()").cast(judged.schema["spans"].dataType)
    return (
        rows.select("rid", "doc_id")
        .join(judged, "rid", "left")
        .select("doc_id", F.coalesce("spans", none).alias("spans"))
    )


def _masked(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; overlaps become one."""
    state = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(
                s["start"] >= acc["at"],
                F.concat(
                    acc["out"],
                    F.array(
                        F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                        F.concat(F.lit("["), s["kind"], F.lit("]")),
                    ),
                ),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
    )
    rest = F.substring(text, state["at"] + 1, F.length(text))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(state["out"], ""), rest)).otherwise(text)


def mask_secrets(
    docs: DataFrame,
    owner: str = "source",
    most_owners: int = MOST_OWNERS,
    most_texts: int = MOST_TEXTS,
) -> DataFrame:
    """``docs`` with all columns, reported spans masked in ``text``; n_chars follows the text.

    Only rows with opaque candidates wait for the corpus counts; all others are
    masked where they are read. Rows without spans stay as they are, columns of any
    other name too. Edge cases as in ``find_secrets``.
    """
    row = F.struct(*(docs[c] for c in docs.columns)).alias("row")
    packed = docs.select(
        row, F.col("doc_id").alias("doc_id"), F.col(owner).alias("owner"), F.col("text").alias("text")
    )
    rows = cut_lineage(
        proposed(packed)
        .withColumn("repository", _repository())
        .drop("text")
        .withColumn("rid", F.monotonically_increasing_id())
    )
    open_rows = F.size("opaque") > 0
    judged = _judged(rows.drop("row"), most_owners, most_texts)
    plain = rows.where(~open_rows).select("row", F.col("base").alias("spans"))
    waited = (
        rows.where(open_rows)
        .join(judged, "rid", "left")
        .select(
            "row",
            F.coalesce(
                F.transform(
                    "spans", lambda s: F.struct(*(s[f] for f in ("start", "rank", "end", "kind", "hash")))
                ),
                F.expr(NONE),
            )
            .cast(f"array<{SPAN}>")
            .alias("spans"),
        )
    )
    masked = plain.unionByName(waited).withColumn(
        "clean", _masked(F.col("row.text"), F.col("spans"))
    )
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("clean")}
    if "n_chars" in columns:
        changed = F.size("spans") > 0
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.when(changed, F.length("clean").cast(kind)).otherwise(
            columns["n_chars"]
        )
    return masked.select(*(value.alias(name) for name, value in columns.items()))
