r"""Chat formatting with a proven round trip, in built-in expressions only.

A turn is written `<|im_start|>role\ntext<|im_end|>\n`. The parser is
deterministic: it cuts at `<|im_end|>\n`, wants `<|im_start|>` in front of every
turn and neither marker within one, takes the role up to the first line end and
undoes the escape `<\|` (one backslash less between `<` and `|`).

Conversations are first written as they are and parsed back. Where the parsed
turns differ from the source, the turns with conflicting content get one more
backslash in every `<|`, `<\|`, `<\\|`, ... and the whole is parsed again; were
it still not identical, the row would raise. Line ends in a role become `<|nl|>`.

The loss mask is run-length coded: `mask_runs` gives, in order, lengths in
characters and whether they are trained on (the texts of `trained_roles`).

Defined results: null text and null role are empty. Turns of a conversation are
ordered by turn (null first), role and text, so ties and repeated rows have one
order and are all kept. Rows without a conversation id form one conversation.
Other columns are ignored, whatever their names. No rows: no conversations. A
conversation is one value and so held by one task (Spark's limit is 2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "<|nl|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(NEWLINE))


def _marked(text: Column) -> Column:
    return F.contains(text, F.lit(START)) | F.contains(text, F.lit(END))


def conflicts(text: Column) -> Column:
    """Text that would not be read back as it is."""
    return _marked(text) | text.rlike(r"<\\+\|")


def _render(turns: Column) -> Column:
    """Turns whose role and text may be written as they are."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(START), t["role"], F.lit("\n"), t["text"], F.lit(END + "\n"))), "")


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation, null if it is not one."""
    parts = F.split(formatted, r"<\|im_end\|>\n")

    def turn(part: Column) -> Column:
        body = F.substring(part, F.lit(len(START) + 1), F.length(part))
        role = F.substring_index(body, "\n", 1)
        text = F.substring(body, F.length(role) + 2, F.length(body))
        good = F.startswith(part, F.lit(START)) & F.contains(body, F.lit("\n")) & ~_marked(body)
        return F.when(good, F.struct(unescape(F.replace(role, F.lit(NEWLINE), F.lit("\n"))).alias("role"), unescape(text).alias("text")))

    def read(cut: Column) -> Column:
        turns = F.transform(F.slice(cut, F.lit(1), F.size(cut) - 1), turn)
        return F.when((F.element_at(cut, -1) == "") & ~F.exists(turns, lambda t: t.isNull()), turns)

    return F.transform(F.array(parts), read)[0]


def _mask(turns: Column, trained_roles: tuple[str, ...]) -> Column:
    def runs(t: Column) -> Column:
        trained = unescape(F.replace(t["role"], F.lit(NEWLINE), F.lit("\n"))).isin(*trained_roles)
        lengths = ((F.length(t["role"]) + len(START) + 1, F.lit(False)), (F.length(t["text"]), trained), (F.lit(len(END) + 1), F.lit(False)))
        return F.array(*[F.struct(n.cast("int").alias("chars"), kind.alias("trained")) for n, kind in lengths])

    return F.flatten(F.transform(turns, runs))


def trained_texts(formatted: Column, mask_runs: Column) -> Column:
    """The texts under the loss mask, cut out of a formatted conversation by the mask's lengths and unescaped.

    Three runs (head, text, end) tell of each turn, so turns are cut one by one.
    """
    def cut(part: Column, i: Column) -> Column:
        head, text = F.get(mask_runs, 3 * i), F.get(mask_runs, 3 * i + 1)
        return F.when(text["trained"], unescape(F.substring(part, head["chars"] + 1, text["chars"])))

    return F.array_compact(F.transform(F.split(formatted, r"<\|im_end\|>\n"), cut))


def format_chats(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """(conv_id, formatted, mask_runs, turns): `turns` is what the parser reads back."""
    empty = F.lit("")
    picked = rows.select(
        rows[conv_id].alias("conv_id"),
        F.struct(rows[turn].alias("turn"), F.coalesce(rows[role], empty).alias("role"), F.coalesce(rows[text], empty).alias("text")).alias("t"),
    )
    ordered = picked.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    source = ordered.select("conv_id", F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"))

    def write(t: Column, safe: bool) -> Column:
        return F.struct(
            (_role(t["role"]) if safe else t["role"]).alias("role"),
            (F.when(conflicts(t["text"]), escape(t["text"])).otherwise(t["text"]) if safe else t["text"]).alias("text"),
        )

    plain = source.withColumn("formatted", _render(F.col("source")))
    first = plain.withColumn("plain_ok", parse(F.col("formatted")).eqNullSafe(F.col("source")))
    written = first.withColumn(
        "written", F.when(F.col("plain_ok"), F.col("source")).otherwise(F.transform("source", lambda t: write(t, True)))
    )
    second = written.select(
        "conv_id", "source", "written",
        F.when(F.col("plain_ok"), F.col("formatted")).otherwise(_render(F.col("written"))).alias("formatted"),
    ).withColumn("turns", parse(F.col("formatted")))
    return second.select(
        "conv_id", "formatted",
        _mask(F.col("written"), trained_roles).alias("mask_runs"),
        F.when(F.col("turns").eqNullSafe(F.col("source")), F.col("turns"))
        .otherwise(F.raise_error(F.concat(F.lit("no round trip for conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))))
        .alias("turns"),
    )
