"""Chat formatting with a proof: what is rendered is parsed again and must give the same turns.

    <|im_start|>ROLE \\n TEXT <|im_end|> \\n          one block per turn, in order

Both control strings are structural wherever they occur, and the parser always removes one backslash from
``<\\...|`` in texts and undoes %25, %0A and %3C in roles. A turn is rendered as it stands when that parses
back to itself. Otherwise it is escaped and tried again. Everything is a column expression.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    for value, code in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        role = F.replace(role, F.lit(value), F.lit(code))
    return role


def unescape_role(role: Column) -> Column:
    for code, value in (("%3C", "<"), ("%0A", "\n"), ("%25", "%")):
        role = F.replace(role, F.lit(code), F.lit(value))
    return role


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(f"{END}\n"))


def parse_blocks(formatted: Column) -> Column:
    """Array of struct(role, text, raw_text), or NULL where the string is not of the grammar."""
    pieces = F.split(formatted, START.replace("|", r"\|"), -1)
    blocks = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    tail = len(END) + 1

    def inner(block: Column) -> Column:
        return F.substring(block, F.lit(1), F.greatest(F.length(block) - tail, F.lit(0)))

    def well_formed(block: Column) -> Column:
        body = inner(block)
        return block.endswith(f"{END}\n") & ~body.contains(END) & body.contains("\n")

    def turn(block: Column) -> Column:
        body = inner(block)
        role = F.substring_index(body, "\n", 1)
        raw = F.substring(body, F.length(role) + 2, F.length(body))
        return F.struct(
            unescape_role(role).alias("role"), unescape_text(raw).alias("text"), raw.alias("raw_text"),
        )

    good = (F.get(pieces, F.lit(0)) == "") & F.forall(blocks, well_formed)
    return F.when(good, F.transform(blocks, turn))


def _is_turn(block: Column, role: Column, text: Column) -> Column:
    turns = parse_blocks(block)
    only = F.get(turns, F.lit(0))
    same = (F.size(turns) == 1) & (only.getField("role") == role) & (only.getField("text") == text)
    return F.coalesce(same, F.lit(False))


def render_safely(role: Column, text: Column) -> Column:
    """The first rendering that parses back to the turn: as it stands, escaped text, escaped text and role."""
    attempts = [
        render_turn(role, text), render_turn(role, escape_text(text)),
        render_turn(escape_role(role), escape_text(text)),
    ]
    return reduce(
        lambda rest, block: F.when(_is_turn(block, role, text), block).otherwise(rest),
        reversed(attempts[:-1]), attempts[-1],
    )


def format_conversations(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", train_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: its id, formatted, turns, loss_spans, identical.

    ``turns`` is what the parser recovers from ``formatted`` (role, text), ``loss_spans`` the places
    (start from 1, length, in code points) of the raw texts of ``train_role``, and ``identical`` says that
    the recovered turns equal the source's. NULL roles and texts count as empty. Rows are ordered by turn,
    NULL first, then by role and text, so ties and repeated rows have one order; all rows are kept. Rows
    without an id form one conversation. Other columns are ignored. An empty table gives an empty result.

    A turn is rendered and checked before rows meet. A conversation is one string in the result, so its
    rows do meet in one task then.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in (role_col, text_col))
    turns = rows.select(
        F.col(conv_col).alias("_conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
    ).withColumn("block", render_safely(F.col("role"), F.col("text")))
    # Where the text of a block begins and how long it is, first in its block and then in the conversation.
    line_end, size = F.instr("block", "\n"), F.length("block")
    order = Window.partitionBy("_conv").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum(size).over(order) - size
    placed = turns.withColumn("span", F.when(F.col("role") == train_role, F.struct(
        (before + line_end + 1).cast("int").alias("start"), (size - line_end - len(END) - 1).alias("length"),
    )))
    whole = placed.groupBy("_conv").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", "block", "span"))).alias("_source"),
    ).select(
        "_conv", F.array_join(F.col("_source.block"), "").alias("formatted"),
        _role_and_text("_source").alias("_said"),
        F.filter("_source.span", lambda span: span.isNotNull()).alias("loss_spans"),
    ).withColumn("_parsed", parse_blocks(F.col("formatted"))).withColumn("turns", _role_and_text("_parsed"))
    return whole.select(
        F.col("_conv").alias(conv_col), "formatted", "turns", "loss_spans",
        F.coalesce(F.col("turns") == F.col("_said"), F.lit(False)).alias("identical"),
    )


def _role_and_text(turns: str) -> Column:
    return F.transform(turns, lambda turn: F.struct(turn["role"].alias("role"), turn["text"].alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped: the spans one after the other."""
    return F.array_join(
        F.transform(spans, lambda s: unescape_text(F.substring(formatted, s["start"], s["length"]))), "",
    )
