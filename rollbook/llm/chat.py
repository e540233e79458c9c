"""Chat formatting checked by a grammar round trip, with SQL functions only.

A conversation is the concatenation of its turns in order, each

    <|im_start|>ROLE
    TEXT<|im_end|>
    (line feed)

The parser is deterministic: it splits at the closing mark, strips the opening mark, takes
the role up to the first line feed and undoes escapes (``\\|`` between ``<`` and ``|``, then
doubled backslashes). Its grammar has ``<|`` only where a mark begins: a role or text with one,
which a tokenizer could read as a control token, is not recovered. Each turn is first
rendered as it stands and parsed back; if the recovered role and text differ, it is rendered
with its conflicts escaped and parsed again. The finished conversation is parsed as a whole
and compared with its source: ``identical``.

Why escapes reverse: they double all backslashes first, so a single one between ``<`` and
``|`` is always the escape's own.

Nulls and ties: a null text is the empty one, a null role too. Turns are ordered by turn
(null first), then role and text; repeated rows are all kept. A null conversation id is a
conversation of its own. Extra columns are ignored. The digest of a conversation runs over
its turns in order, so a conversation has to fit one row (2 GB); conversations, not rows,
are what is spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Fixed marks of the template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def escaped(text: Column, role: bool = False) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    out = F.replace(out, F.lit("<|"), F.lit("<\\|"))
    # A role ends at its line feed; a backslash and n stand for one inside it.
    return F.replace(out, F.lit("\n"), F.lit("\\n")) if role else out


def unescaped(text: Column, role: bool = False) -> Column:
    if role:
        # An odd backslash before n is a line feed: doubled ones step aside meanwhile.
        held = F.replace(text, F.lit("\\\\"), F.lit("\\\x00"))
        held = F.replace(F.replace(held, F.lit("<\\|"), F.lit("<|")), F.lit("\\n"), F.lit("\n"))
        return F.replace(held, F.lit("\\\x00"), F.lit("\\"))
    out = F.replace(text, F.lit("<\\|"), F.lit("<|"))
    return F.replace(out, F.lit("\\\\"), F.lit("\\"))


def rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit("\n"), text, F.lit(CLOSE))


def parsed(formatted: Column) -> Column:
    """Turns of a formatted conversation: array of ``role``, ``text`` (null where the grammar has
    none), ``body`` (as it stands in the output)."""
    pieces = F.split(formatted, F.lit(r"\Q" + CLOSE + r"\E"), -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(len(OPEN) + 1), F.length(piece))
        cut = F.instr(inner, F.lit("\n"))
        role, body = F.substring(inner, F.lit(1), cut - 1), F.substring(inner, cut + 1, F.length(inner))
        return F.struct(
            F.when(~role.contains("<|"), unescaped(role, role=True)).alias("role"),
            F.when(~body.contains("<|"), unescaped(body)).alias("text"),
            body.alias("body"),
        )

    return F.transform(pieces, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask: cut out of the output and read back."""
    cut = F.transform(spans, lambda s: F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))
    return F.array_join(F.transform(cut, lambda body: unescaped(body)), "")


def _plain_turns(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def format_turns(rows: DataFrame) -> DataFrame:
    """Each turn with ``formatted``: as it stands if the parser gives it back so, else escaped."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    plain = rendered(F.col("role"), F.col("text"))
    source = F.array(F.struct(F.col("role").alias("role"), F.col("text").alias("text")))
    same = _plain_turns(parsed(plain)) == source
    return turn.withColumn(
        "formatted",
        F.when(same, plain).otherwise(rendered(escaped(F.col("role"), role=True), escaped(F.col("text")))),
    )


def format_conversations(rows: DataFrame) -> DataFrame:
    """Per conversation: ``conv_id``, ``formatted``, ``turns`` (read back from it),
    ``loss_spans`` (start and end in ``formatted`` of each assistant text, in code points),
    ``identical`` (the turns read back equal the source's)."""
    turn = format_turns(rows)
    size = F.length("formatted").cast("long")
    ordered = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    end = F.sum(size).over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - len(CLOSE)
    body = F.element_at(parsed(F.col("formatted")), 1)["body"]
    span = F.struct((end - F.length(body)).alias("start"), end.alias("end"))
    turn = turn.withColumn("span", F.when(F.col("role") == TRAINED_ROLE, span))
    whole = turn.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "formatted", "span"))).alias("source")
    )
    whole = whole.withColumn("formatted", F.array_join(F.transform("source", lambda t: t["formatted"]), ""))
    whole = whole.withColumn("turns", parsed(F.col("formatted")))
    spans = F.transform("source", lambda t: t["span"])
    return whole.select(
        "conv_id",
        "formatted",
        "turns",
        F.filter(spans, lambda s: s.isNotNull()).alias("loss_spans"),
        (_plain_turns(F.col("turns")) == _plain_turns(F.col("source"))).alias("identical"),
    )
