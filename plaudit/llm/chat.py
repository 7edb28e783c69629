r"""Chat formatting with a grammar round trip, in DataFrame functions only.

A formatted conversation is a row of turns, each of them

    ### role: text
    </turn>

Control strings are ``### `` and ``</turn>``.  Inside a text they are escaped by one more
backslash than they already have in front (``</turn>`` becomes ``\</turn>``, ``\</turn>``
becomes ``\\</turn>``), which can always be undone.  In a role ``%``, ``:``, ``#``, ``<`` and
line breaks are percent-coded.

Texts are first rendered as they are and parsed back.  Turns that do not come back equal
are escaped and the conversation is rendered and parsed again; one that still differs
fails the job instead of leaving silently changed text.

Defined cases: a null role or text is an empty one; turns go by number, then role, then
text, nulls first, so repeated rows and ties have one order and each row stays a turn; null
is a conversation of its own; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CONTROL = r"(### |</turn>)"
TURN_END = "\n</turn>\n"
TURN = "array<struct<role:string,text:string>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\*)" + CONTROL, r"\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\*)" + CONTROL, "$1$2")


def has_control(text: Column) -> Column:
    """A control string without a backslash in front."""
    return text.rlike(r"(?<!\\)" + CONTROL)


_ROLE_CODES = (("%", "%25"), (":", "%3A"), ("#", "%23"), ("<", "%3C"), ("\n", "%0A"), ("\r", "%0D"))


def role_code(role: Column) -> Column:
    for plain, code in _ROLE_CODES:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def role_of(code: Column) -> Column:
    for plain, coded in reversed(_ROLE_CODES):
        code = F.replace(code, F.lit(coded), F.lit(plain))
    return code


def render(turns: Column) -> Column:
    """Formatted text of ``array<struct<role,body>>`` with bodies escaped as far as needed."""
    shown = F.transform(turns, lambda t: F.concat(F.lit("### "), role_code(t.role), F.lit(": "), t.body, F.lit(TURN_END)))
    return F.array_join(shown, "")


def parse_pieces(formatted: Column) -> Column:
    """Grammar of the format: ``array<struct<role,body>>`` with bodies still escaped; a turn
    that breaks the grammar has a null role."""
    # no regex sign in the end mark
    pieces = F.split(formatted, TURN_END, -1)
    whole = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    header = r"(?s)\A### ([^:\n]*): (.*)\z"

    def turn(piece: Column) -> Column:
        body = F.regexp_extract(piece, header, 2)
        good = piece.rlike(header) & ~has_control(body)
        return F.struct(F.when(good, role_of(F.regexp_extract(piece, header, 1))).alias("role"), body.alias("body"))

    return F.transform(whole, turn)


def parse(formatted: Column) -> Column:
    """Turns with their texts as they were before formatting."""
    return F.transform(
        parse_pieces(formatted),
        lambda t: F.struct(t.role.alias("role"), F.when(t.role.isNotNull(), unescape(t.body)).alias("text")),
    )


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per ``conv_id``: ``formatted``, the ``turns`` parsed back from it and
    ``n_escaped``, the number of turns that needed escapes."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    row = F.struct(F.col("turn"), blank("role").alias("role"), blank("text").alias("text"))
    source = (
        rows.select("conv_id", row.alias("_row"))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("_row")).alias("_rows"))
        .select("conv_id", F.transform("_rows", lambda r: F.struct(r.role.alias("role"), r.text.alias("text"))).alias("_source"))
    )
    raw = F.transform("_source", lambda t: F.struct(t.role.alias("role"), t.text.alias("body")))
    first = source.withColumn("_plain", render(raw)).withColumn("_back", parse("_plain"))
    # a turn conflicts when it does not survive on its own
    conflicts = lambda t: has_control(t.text) | (unescape(t.text) != t.text)
    escaped = F.transform(
        "_source",
        lambda t: F.struct(t.role.alias("role"), F.when(conflicts(t), escape(t.text)).otherwise(t.text).alias("body")),
    )
    same = F.col("_back") == F.col("_source")
    second = first.select(
        "conv_id",
        "_source",
        F.when(same, F.col("_plain")).otherwise(render(escaped)).alias("formatted"),
        F.when(same, F.lit(0)).otherwise(F.size(F.filter("_source", conflicts))).alias("n_escaped"),
    ).withColumn("turns", parse("formatted"))
    failed = F.raise_error(F.concat(F.lit("turns do not come back from conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    checked = F.when(F.col("turns") == F.col("_source"), F.col("turns")).otherwise(failed.cast(TURN))
    return second.select("conv_id", "formatted", checked.alias("turns"), "n_escaped")


def loss_segments(formatted: Column, role: str = "assistant") -> Column:
    """The formatted text as ``array<struct<piece,in_loss>>``; the pieces join to the whole
    text, those in the loss are the (escaped) texts of one role."""
    return F.flatten(
        F.transform(
            parse_pieces(formatted),
            lambda t: F.array(
                F.struct(F.concat(F.lit("### "), role_code(t.role), F.lit(": ")).alias("piece"), F.lit(False).alias("in_loss")),
                F.struct(t.body.alias("piece"), (t.role == role).alias("in_loss")),
                F.struct(F.lit(TURN_END).alias("piece"), F.lit(False).alias("in_loss")),
            ),
        )
    )


def digest(formatted: DataFrame) -> DataFrame:
    """Counts and digests read back from ``formatted``."""
    parts = formatted.select("conv_id", "formatted", "turns", loss_segments(F.col("formatted")).alias("_parts"))
    texts = F.transform(F.filter("_parts", lambda p: p.in_loss), lambda p: unescape(p.piece))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    read = parts.select("conv_id", "formatted", "turns", F.array_join(texts, "").alias("_loss"), told.alias("_told"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.col("_told").cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
