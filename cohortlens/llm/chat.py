"""Chat formatting in budgeted windows, in built-in expressions only.

Prefix sums of the turns' tokens cut a conversation into windows of whole
turns. Each window starts with the conversation's system turn and some repeated
history; only assistant texts of its new turns are learned, so each is learned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import cut_lineage

#: The control strings of the template. Texts cannot contain them, because
#: every "<|" inside a text is written as "<\|" and every backslash twice.
START, MIDDLE, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Tokens of a window, and of the history it may repeat. A token is taken as four bytes.
BUDGET = 1024
HISTORY = 256
#: Turns of a conversation whose running sum is taken in one go; sums of such ranges come first.
RANGE_TURNS = 256


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def _written(turns: DataFrame) -> DataFrame:
    """Turns with their formatted parts, as a table, so that their numbers stay the same."""
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit(MIDDLE))
    rows = (
        turns.select(
            "conv_id",
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .withColumn("head", head)
        .withColumn("body", escape(F.col("text")))
        .withColumn(
            "cost",
            F.floor((F.octet_length("head") + F.octet_length("body") + len(END) + 3) / 4),
        )
        .withColumn("tie", F.md5("text"))
        .drop("text")
    )
    return cut_lineage(rows.withColumn("uid", F.monotonically_increasing_id()))


def _numbered(rows: DataFrame) -> DataFrame:
    """(uid, conv_id, role, cost, n, at): place and first token within the conversation.

    No texts here: a few numbers for each turn go through the windows and joins.
    """
    rows = rows.select("uid", "conv_id", "turn", "role", "tie", "cost").withColumn(
        "range", F.coalesce(F.floor(F.col("turn") / RANGE_TURNS), F.lit(-(2**61)).cast("long"))
    )
    ranges = rows.groupBy("conv_id", "range").agg(
        F.sum("cost").alias("cost"), F.count(F.lit(1)).alias("rows")
    )
    before = (
        Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = ranges.select(
        F.col("conv_id").alias("o_id"),
        F.col("range").alias("o_range"),
        F.coalesce(F.sum("cost").over(before), F.lit(0)).alias("o_at"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("o_n"),
    )
    inside = Window.partitionBy("conv_id", "range").orderBy(
        F.col("turn").asc_nulls_first(), "role", "tie", "uid"
    )
    return (
        rows.withColumn("at", F.sum("cost").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("n", F.row_number().over(inside))
        .join(
            offsets,
            F.col("conv_id").eqNullSafe(F.col("o_id")) & (F.col("range") == F.col("o_range")),
        )
        .select(
            "uid",
            "conv_id",
            "role",
            "cost",
            (F.col("o_n") + F.col("n") - 1).alias("n"),
            (F.col("o_at") + F.col("at") - F.col("cost")).alias("at"),
        )
    )


def format_chats(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Training windows from ``turns`` (conv_id, turn, role, text).

    Returns conv_id, window, text, n_context and loss: the formatted text, how
    many of its turns only repeat context, and the character ranges (start, end
    exclusive) to learn. System turn, history and new turns stay within
    ``budget`` tokens, unless the system turn, ``history`` and one turn alone
    are more; turns are never cut. Windows are cut by prefix sums: turns that
    lie within the same stretch of the room left for new turns are one window,
    a turn across the end of a stretch is a window by itself. The first system
    turn is repeated at the start of every later window.

    Turns are ordered by turn (null first), then role, then a digest of the
    text; equal rows stay apart. A null role or text counts as empty, a null conv_id as a
    conversation. Other columns are ignored; an empty table gives no windows.
    """
    texts = _written(turns)
    rows = cut_lineage(_numbered(texts))
    system = (
        rows.where(F.col("role") == "system")
        .groupBy("conv_id")
        .agg(F.min_by(F.struct("uid", "n", "cost"), "n").alias("s"))
        .select(F.col("conv_id").alias("s_id"), "s")
    )
    room = F.greatest(F.lit(budget - history) - F.coalesce(F.col("s.cost"), F.lit(0)), F.lit(1))
    stretch = F.floor(F.col("at") / F.col("room"))
    last = F.floor((F.col("at") + F.col("cost") - 1) / F.col("room"))
    rows = cut_lineage(
        rows.join(system, F.col("conv_id").eqNullSafe(F.col("s_id")), "left")
        .withColumn("room", room)
        .withColumn("window", 2 * stretch + (last > stretch).cast("long"))
        .select("uid", "conv_id", "n", "at", "cost", "window", "s")
    )
    windows = rows.groupBy("conv_id", "window").agg(
        F.min("n").alias("w_n"), F.min("at").alias("w_at"), F.first("s").alias("s")
    )

    # which turn stands where: its number, its window and its part of it
    fresh = rows.select("uid", "window", F.lit(2).alias("part"), "n")
    kept = windows.where(F.col("w_n") > F.col("s.n")).select(
        "s.uid", "window", F.lit(0).alias("part"), "s.n"
    )
    # a turn can be history of windows that begin in [its end, its begin + history]: two
    # stretches of that length, so windows and turns meet on the stretch
    past = (
        rows.where(
            (F.col("cost") <= history) & ~F.coalesce(F.col("n") == F.col("s.n"), F.lit(False))
        )
        .withColumn(
            "meet",
            F.explode(
                F.sequence(
                    F.floor((F.col("at") + F.col("cost")) / history),
                    F.floor((F.col("at") + history) / history),
                )
            ),
        )
        .select("uid", F.col("conv_id").alias("p_id"), "meet", "n", "at", "cost")
    )
    begins = windows.select(
        "conv_id", "window", "w_at", F.floor(F.col("w_at") / history).alias("w_meet")
    )
    repeated = begins.join(
        past,
        F.col("conv_id").eqNullSafe(F.col("p_id"))
        & (F.col("w_meet") == F.col("meet"))
        & (F.col("at") + F.col("cost") <= F.col("w_at"))
        & (F.col("at") + history >= F.col("w_at")),
    ).select("uid", "window", F.lit(1).alias("part"), "n")

    # the texts move twice: to their places, and into the windows. A window is bounded by
    # the budget, so its turns may meet in one row
    learned = (F.col("part") == 2) & (F.col("role") == "assistant")
    built = (
        fresh.unionByName(kept)
        .unionByName(repeated)
        .join(texts.select("uid", "conv_id", "role", "head", "body"), "uid")
        .select(
            "conv_id",
            "window",
            "part",
            "n",
            F.concat("head", "body", F.lit(END)).alias("piece"),
            F.when(learned, F.length("head")).alias("skip"),
            F.when(learned, F.length("body")).alias("take"),
        )
        .groupBy("conv_id", "window")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("part", "n", "piece", "skip", "take"))
            ).alias("t")
        )
    )
    spans = F.aggregate(
        "t",
        F.struct(
            F.lit(0).alias("at"),
            F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("out"),
        ),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["piece"])).alias("at"),
            F.when(
                t["skip"].isNotNull(),
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["at"] + t["skip"]).alias("start"),
                            (acc["at"] + t["skip"] + t["take"]).alias("end"),
                        )
                    ),
                ),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
    )["out"]
    return built.select(
        "conv_id",
        "window",
        F.array_join(F.transform("t", lambda t: t["piece"]), "").alias("text"),
        F.size(F.filter("t", lambda t: t["part"] < 2)).alias("n_context"),
        spans.alias("loss"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """(conv_id, window, chars, turns, learned) parsed from formatted windows.

    ``turns`` are the new turns (role, text), ``learned`` the texts under the loss mask.
    """
    pieces = F.split("text", r"<\|im_end\|>")
    new = F.slice(pieces, F.col("n_context") + 1, F.size(pieces) - 1 - F.col("n_context"))
    parts = F.transform(
        new, lambda p: F.split(F.substr(p, F.lit(len(START) + 1)), r"<\|im_sep\|>", 2)
    )
    return examples.select(
        "conv_id",
        "window",
        F.length("text").cast("long").alias("chars"),
        F.transform(
            parts, lambda p: F.struct(unescape(p[0]).alias("role"), unescape(p[1]).alias("text"))
        ).alias("turns"),
        F.transform(
            "loss",
            lambda s: unescape(F.substring(F.col("text"), s["start"] + 1, s["end"] - s["start"])),
        ).alias("learned"),
    )


def chat_digest(examples: DataFrame) -> DataFrame:
    """Per conversation counts and digests of what is read back from its windows.

    A digest is over the whole conversation, so this report holds one
    conversation's text at a time; the windows themselves are bounded.
    """
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    folded = (
        read_back(examples)
        .select(
            "conv_id",
            "chars",
            F.size("turns").alias("n"),
            F.struct(
                "window", said.alias("said"), F.array_join("learned", "").alias("learned")
            ).alias("w"),
        )
        .groupBy("conv_id")
        .agg(
            F.sum("n").cast("long").alias("n_turns"),
            F.array_sort(F.collect_list("w")).alias("w"),
            F.sum("chars").alias("formatted_chars"),
        )
        .withColumn("learned", F.array_join(F.transform("w", lambda w: w["learned"]), ""))
        .withColumn("said", F.array_join(F.transform("w", lambda w: w["said"]), ""))
    )
    return folded.select(
        "conv_id",
        "n_turns",
        F.sha2("said", 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )
