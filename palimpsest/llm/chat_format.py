r"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs in slices by turn number, sorted, and adjacent turns
of one role are merged by an array aggregation over bounded pieces; slices are then joined and concatenated.

The template, with the role and every text escaped::

    <s> block ... </s>
    block:            [INST] role [ROLE] text ([PART] text)* [/INST]
    assistant block:  [REPLY] role [ROLE] text ([PART] text)* [/REPLY]

Merged turns share one block, ``[PART]`` keeps their bounds, so every turn can be read back.
A control string inside a role or text gets a backslash after its first character, and one
that already looks escaped gets one more, so escaping is a bijection.

Defined results: null text and null role are empty; a null conversation id is a conversation of
its own; turns with equal or null numbers are ordered by (turn, nulls first; role; text);
repeated rows are repeated turns; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.common import own_columns, table

#: Turn numbers that one first-level slice spans.
SLICE = 256
CONTROL = r"(/?s>|/?INST\]|/?REPLY\]|ROLE\]|PART\])"
OPEN = r"([<\[])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, OPEN + r"(\\*)" + CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, OPEN + r"\\(\\*)" + CONTROL, "$1$2$3")


def format_conversations(turns: DataFrame, loss_role: str = "assistant", slice_turns: int = SLICE) -> DataFrame:
    """One row per conversation: ``conv_id, n_blocks, formatted, mask``.

    ``mask``: an array of ``start, length``, in bytes of ``formatted`` as UTF-8: the bare texts of ``loss_role``, one span for each turn.
    """
    rows = own_columns(turns, "conv_id", "turn", "role", "text").select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.floor(F.col("turn") / slice_turns).alias("slice"),
    )
    # Turns of a slice in order, then runs of one role folded into blocks of several parts.
    turn_list = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    no_blocks = F.array().cast("array<struct<role:string,parts:array<string>>>")

    def fold(acc: Column, t: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.struct(t["role"].alias("role"), F.concat(last["parts"], F.array(t["text"])).alias("parts"))
        alone = F.array(F.struct(t["role"].alias("role"), F.array(t["text"]).alias("parts")))
        merged = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(joined))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["role"] == t["role"]), merged).otherwise(F.concat(acc, alone))

    slices = rows.groupBy("conv_id", "slice").agg(turn_list.alias("turns"))
    # Null or repeated numbers can make a slice of any size; a fold has a slice's worth of turns all the same.
    cuts = F.sequence(F.lit(1), F.size("turns"), F.lit(slice_turns))
    folded = F.transform(cuts, lambda at: F.aggregate(F.slice("turns", at, F.lit(slice_turns)), no_blocks, fold))
    slices = slices.select("conv_id", "slice", F.flatten(folded).alias("blocks"))
    whole = slices.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("slice", "blocks"))).alias("s"))
    whole = whole.select("conv_id", F.flatten(F.col("s.blocks")).alias("blocks"))

    # A block opens its own template unless it goes on a run that the slice bound has cut.
    def role_at(i: Column) -> Column:
        return F.get("blocks", i)["role"]

    def rendered(b: Column, i: Column) -> Column:
        goes_on = F.coalesce(role_at(i - 1) == b["role"], F.lit(False))
        ends = ~F.coalesce(role_at(i + 1) == b["role"], F.lit(False))
        reply = b["role"] == loss_role
        head = F.concat(F.when(reply, "[REPLY]").otherwise("[INST]"), escape(b["role"]), F.lit("[ROLE]"))
        tail = F.when(~ends, "").when(reply, "[/REPLY]").otherwise("[/INST]")
        parts = F.flatten(
            F.transform(
                b["parts"],
                lambda p, k: F.array(
                    F.struct(F.when((k == 0) & ~goes_on, head).otherwise("[PART]").alias("text"), F.lit(False).alias("loss")),
                    F.struct(escape(p).alias("text"), reply.alias("loss")),
                ),
            )
        )
        return F.concat(parts, F.array(F.struct(tail.alias("text"), F.lit(False).alias("loss"))))

    def bare(s: str) -> Column:
        return F.array(F.struct(F.lit(s).alias("text"), F.lit(False).alias("loss")))

    segments = F.concat(bare("<s>"), F.flatten(F.transform("blocks", rendered)), bare("</s>"))
    heads = F.size(F.filter("blocks", lambda b, i: ~F.coalesce(role_at(i - 1) == b["role"], F.lit(False))))
    out = whole.select("conv_id", heads.cast("long").alias("n_blocks"), segments.alias("segments"))
    return out.select("conv_id", "n_blocks", F.concat_ws("", F.col("segments.text")).alias("formatted"), _mask(F.col("segments"), slice_turns).alias("mask"))


def _mask(segments: Column, piece: int) -> Column:
    """Spans of the segments with ``loss``; sums run over pieces and then over the pieces' own sums, so that no array grows step by step beyond them."""
    sizes = F.transform(segments, lambda s: F.struct(F.octet_length(s["text"]).cast("long").alias("length"), s["loss"].alias("loss")))
    none = F.array().cast("array<struct<start:bigint,length:bigint>>")
    nothing = F.struct(F.lit(0).cast("long").alias("total"), none.alias("spans"))

    def add(acc: Column, s: Column) -> Column:
        span = F.array(F.struct(acc["total"].alias("start"), s["length"].alias("length")))
        return F.struct((acc["total"] + s["length"]).alias("total"), F.when(s["loss"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    def join(acc: Column, p: Column) -> Column:
        moved = F.transform(p["spans"], lambda s: F.struct((s["start"] + acc["total"]).alias("start"), s["length"].alias("length")))
        return F.struct((acc["total"] + p["total"]).alias("total"), F.concat(acc["parts"], F.array(moved)).alias("parts"))

    # A one-element array binds what is computed once to a name.
    cut = lambda all_: F.transform(F.sequence(F.lit(1), F.size(all_), F.lit(piece)), lambda at: F.aggregate(F.slice(all_, at, F.lit(piece)), nothing, add))
    pieces = F.get(F.transform(F.array(sizes), cut), F.lit(0))
    start = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<array<struct<start:bigint,length:bigint>>>").alias("parts"))
    return F.flatten(F.aggregate(pieces, start, join)["parts"])


def read_back(formatted: DataFrame) -> DataFrame:
    """``turns`` (role and text of each turn) parsed from ``formatted``, and ``loss_text`` from under the mask."""
    body = F.regexp_replace(F.regexp_replace("formatted", r"\A<s>", ""), r"</s>\z", "")
    blocks = F.filter(F.split(body, r"\[/(?:INST|REPLY)\]"), lambda b: b != "")
    inner = F.transform(blocks, lambda b: F.split(F.regexp_replace(b, r"\A\[(?:INST|REPLY)\]", ""), r"\[ROLE\]"))
    turns = F.flatten(
        F.transform(
            inner,
            lambda b: F.transform(F.split(b[1], r"\[PART\]"), lambda p: F.struct(unescape(b[0]).alias("role"), unescape(p).alias("text"))),
        )
    )
    # Bytes are cut without a walk from the text's beginning; the array binds them to a name.
    text = lambda raw, s: unescape(F.decode(F.substring(raw, s["start"].cast("int") + 1, s["length"].cast("int")), "UTF-8"))
    loss = F.get(F.transform(F.array(F.encode("formatted", "UTF-8")), lambda raw: F.concat_ws("", F.transform("mask", lambda s: text(raw, s)))), F.lit(0))
    return formatted.select("*", turns.alias("turns"), loss.alias("loss_text"))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digests of all conversations and of conversation -1."""
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = own_columns(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text").unionByName(extra)
    back = read_back(format_conversations(rows))
    digest = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(digest, "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss_text", "UTF-8"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "n_blocks",
    )


#: n_blocks counts runs of one role; formatted_chars follows the template's own lengths.
OP1_SQL = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
k AS (
  SELECT *, row_number() OVER w AS n, coalesce(lag(role) OVER w <> role, true) AS opens,
    length(text) + len(regexp_extract_all(text, '[<\[]\\*(/?s>|/?INST\]|/?REPLY\]|ROLE\]|PART\])')) AS chars,
    length(role) + len(regexp_extract_all(role, '[<\[]\\*(/?s>|/?INST\]|/?REPLY\]|ROLE\]|PART\])')) AS role_chars
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY n)) AS loss_sha256,
  CAST(7 + sum(chars) + sum(CASE WHEN opens THEN role_chars + 6 + CASE WHEN role = 'assistant' THEN 15 ELSE 13 END
                            ELSE 6 END) AS BIGINT) AS formatted_chars,
  CAST(count_if(opens) AS BIGINT) AS n_blocks
FROM k GROUP BY conv_id
"""
