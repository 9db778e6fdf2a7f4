"""Chat formatting with Spark expressions only.

The rows of a conversation are collected as structs and sorted; neighbouring rows of one role
become one message; messages are joined to a single text:

    <|im_start|>ROLE\\nTEXT<|im_sep|>TEXT<|im_end|>\\n<|im_start|>ROLE\\n ...

``<|im_sep|>`` stands where two rows of one role were merged, so that reading back gives the rows.
Inside roles and texts ``\\`` is written ``\\s`` and ``<|`` is written ``<\\p``; in roles a line feed
is written ``\\n``. No control string can therefore come out of a text, and unescaping is exact.

Defined results: null role or text counts as empty; null turns sort first; rows with equal turn
numbers sort by role, then text; repeated rows are turns of their own; null conversation ids form
one conversation; an empty table gives no rows. A conversation becomes one row, so it must fit
Spark's limit of 2 GB a value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Pieces whose lengths are added up together, and code points that are cut out together: work grows in
#: proportion to a conversation, not with its square.
_PIECES, _BLOCK = 256, 4096

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"


def _escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<|"), F.lit("<\\p"))


def _unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\p"), F.lit("<|")), F.lit("\\s"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(_escape(role), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    return _unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def _let(value: Column, use) -> Column:
    """``use(value)``, the value being computed once however often and wherever it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(numbers: Column) -> Column:
    """Sum of all numbers before each one. The array grows by copies, so it must be short."""
    done = F.aggregate(
        numbers, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("sums")),
        lambda done, n: F.struct((done["at"] + n).alias("at"),
                                 F.array_append(done["sums"], done["at"]).alias("sums")))
    return done["sums"]


def _starts(lengths: Column) -> Column:
    """Sum of all lengths before each one: within groups of pieces, and over the groups."""
    count = F.ceil(F.size(lengths) / F.lit(_PIECES)).cast("int")
    groups = F.transform(F.sequence(F.lit(0), count - 1),
                         lambda k: F.slice(lengths, k * _PIECES + 1, F.lit(_PIECES)))
    total = lambda group: F.aggregate(group, F.lit(0).cast("long"), lambda s, n: s + n)
    return _let(groups, lambda g: _let(_running(F.transform(g, total)), lambda before: F.flatten(
        F.transform(g, lambda group, k: F.transform(_running(group), lambda at: at + F.get(before, k))))))


def _messages(turns: Column) -> Column:
    """Sorted turns -> array of (role, texts), one per run of equal roles.

    The ends of the runs are found first, then each run is one slice: linear in the turns.
    """
    n = F.size(turns)
    role_at = lambda i: F.get(turns, i)["role"]
    starts = F.filter(F.sequence(F.lit(0), n - 1),
                      lambda i: (i == 0) | (role_at(i) != role_at(i - 1)))
    return _let(F.array_append(starts, n), lambda bounds: F.transform(
        F.slice(bounds, F.lit(1), F.size(bounds) - 1), lambda start, k: F.struct(
            role_at(start).alias("role"),
            F.transform(F.slice(turns, start + 1, F.get(bounds, k + 1) - start),
                        lambda t: t["text"]).alias("texts"),
        )))


def format_conversations(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text",
                         trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: its id, ``formatted`` and ``loss_spans``.

    ``loss_spans`` lists (start, length) in code points of ``formatted``, from 0, of every text of
    ``trained_role`` in order. Other columns of ``rows`` are ignored.
    """
    turns = rows.select(
        F.col(conversation).alias("conversation"),
        F.struct(
            F.col(turn).alias("turn"),
            _escape_role(F.coalesce(F.col(role), F.lit(""))).alias("role"),
            _escape(F.coalesce(F.col(text), F.lit(""))).alias("text"),
        ).alias("t"),
    )
    collected = turns.groupBy("conversation").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    messages = collected.select("conversation", _messages(F.col("turns")).alias("messages"))
    # Each message as its pieces; the length of all before gives the place of a text.
    pieces = F.flatten(F.transform("messages", lambda m: F.concat(
        F.array(F.struct(F.concat(F.lit(START), m["role"], F.lit("\n")).alias("text"),
                         F.lit(False).alias("trained"))),
        F.flatten(F.transform(m["texts"], lambda t, i: F.array(
            F.struct(F.when(i > 0, F.lit(SEP)).otherwise(F.lit("")).alias("text"),
                     F.lit(False).alias("trained")),
            F.struct(t.alias("text"),
                     (m["role"] == _escape_role(F.lit(trained_role))).alias("trained")),
        ))),
        F.array(F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("trained"))),
    )))
    cut = messages.select("conversation", pieces.alias("pieces"))
    lengths = F.transform("pieces", lambda p: F.char_length(p["text"]).cast("long"))
    spans = _let(lengths, lambda sizes: _let(_starts(sizes), lambda starts: F.transform(
        F.filter(F.transform(F.col("pieces"), lambda p, i: F.struct(
            p["trained"].alias("trained"), F.get(starts, i).alias("start"),
            F.get(sizes, i).alias("length"))), lambda s: s["trained"]),
        lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))))
    return cut.select(
        F.col("conversation").alias(conversation),
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        spans.alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """Formatted text -> array of (role, text), the rows that went in."""
    parts = F.split(formatted, r"<\|im_start\|>")  # the first is what stands before all marks
    messages = F.slice(parts, F.lit(2), F.size(parts) - 1)
    return F.flatten(F.transform(messages, lambda m: _read_message(m)))


def _read_message(message: Column) -> Column:
    break_at = F.instr(message, "\n")
    role = _unescape_role(F.substring(message, F.lit(1), break_at - 1))
    body = F.substring(message, break_at + 1,
                       F.char_length(message) - break_at - len(END) - 1)
    return F.transform(F.split(body, r"<\|im_sep\|>"),
                       lambda t: F.struct(role.alias("role"), _unescape(t).alias("text")))


def read_trained(formatted: Column, spans: Column) -> Column:
    """Text under the loss mask, unescaped. Each span is cut out of the few blocks it lies in."""
    blocks = F.regexp_extract_all(formatted, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))

    def text_of(held: Column, span: Column) -> Column:
        first = F.call_function("div", span["start"], F.lit(_BLOCK)).cast("int")
        last = F.call_function("div", span["start"] + span["length"], F.lit(_BLOCK)).cast("int")
        near = F.array_join(F.slice(held, first + 1, last - first + 1), "")
        return F.substring(near, (span["start"] % _BLOCK + 1).cast("int"), span["length"].cast("int"))

    return _let(blocks, lambda held: F.array_join(
        F.transform(spans, lambda s: _unescape(text_of(held, s))), ""))
