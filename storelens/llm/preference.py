"""Preference formatting: the longest common turn prefix of a chosen and a rejected
conversation becomes the prompt, rendered once, and the rest of each a completion with
the stretches to train on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SIDES = ("chosen", "rejected")


def _plain(text: Column) -> Column:
    """The text with the template's marks made harmless, so that it cannot forge a turn."""
    out = F.coalesce(text, F.lit(""))
    for mark in (OPEN, CLOSE):
        out = F.replace(out, F.lit(mark), F.lit(mark.replace("<|", "< |")))
    return out


def _head(role: Column) -> Column:
    return F.concat(F.lit(OPEN), _plain(F.regexp_replace(role, r"[\r\n]+", " ")), F.lit("\n"))


TURN = "struct<turn: bigint, role: string, text: string>"


def format_preferences(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per pair: ``pair_id``, ``common_turns``, ``prompt``, and for each side
    ``<side>`` (the completion), ``<side>_spans`` (start and end, in characters of the
    completion, of what ``trained_role`` says, end mark included) and ``usable``.

    ``turns`` has ``pair_id``, ``side`` (chosen or rejected), ``turn``, ``role`` and
    ``text``.  The turns of a side come in order of ``turn``, then role, then text, nulls
    first; repeated rows are turns each.  Two turns are equal if role and text are, null
    equal to null.  A null role is ``user`` and a null text is empty when rendered.  A
    pair is usable if the two completions differ and each trains on something.  Rows
    with a null pair id or another side are left out; a pair without one side has an
    empty prompt and an empty completion there.  An empty table gives an empty table.

    The turns are shuffled once, to the pair they belong to; a pair is one row.
    """
    said = F.struct(F.col("turn").cast("bigint").alias("turn"), "role", "text")
    pairs = turns.filter(F.col("pair_id").isNotNull() & F.col("side").isin(*SIDES)).groupBy("pair_id").agg(
        *(F.collect_list(F.when(F.col("side") == side, said)).alias(side) for side in SIDES)
    )
    return format_pairs(pairs, trained_role)


def format_pairs(pairs: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """As :func:`format_preferences`, from one row per pair: ``pair_id`` and, as arrays of
    (turn, role, text) in any order, ``chosen`` and ``rejected``."""
    def same(a: Column, b: Column) -> Column:
        return a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"])

    # position by position, up to the first two turns that differ or the end of a side
    longest = F.greatest(F.size("chosen"), F.size("rejected"))
    agree = F.zip_with("chosen", "rejected", lambda a, b: a.isNotNull() & b.isNotNull() & same(a, b))
    common = F.coalesce(F.nullif(F.array_position(agree, F.lit(False)).cast("int"), F.lit(0)) - 1, longest)

    def rendered(turn: Column) -> Column:
        head = _head(F.coalesce(turn["role"], F.lit("user")))
        body = F.concat(_plain(turn["text"]), F.lit(CLOSE))
        return F.struct(
            F.concat(head, body, F.lit("\n")).alias("shown"), F.char_length(head).alias("skip"),
            F.char_length(body).alias("said"), (F.coalesce(turn["role"], F.lit("user")) == trained_role).alias("train"),
        )

    ordered = pairs.select("pair_id", *(F.sort_array(F.col(side).cast(f"array<{TURN}>")).alias(side) for side in SIDES))
    cut = ordered.withColumn("common_turns", common)
    # the prompt's turns are taken from the chosen side alone
    parts = {"prompt": F.slice("chosen", F.lit(1), F.col("common_turns"))} | {
        side: F.slice(side, F.col("common_turns") + 1, F.size(side)) for side in SIDES
    }
    shown = cut.select("pair_id", "common_turns", *(F.transform(c, rendered).alias(k) for k, c in parts.items()))
    texts = {into: F.array_join(F.transform(into, lambda p: p["shown"]), "") for into in parts}
    out = shown.select(
        "pair_id", F.col("common_turns").cast("long").alias("common_turns"), *(c.alias(k) for k, c in texts.items()),
        *(_spans(F.col(side)).alias(f"{side}_spans") for side in SIDES),
    )
    usable = (F.size("chosen_spans") > 0) & (F.size("rejected_spans") > 0) & ~F.col("chosen").eqNullSafe(F.col("rejected"))
    return out.withColumn("usable", usable)


def _spans(parts: Column) -> Column:
    """Where the trained turns' words stand in the parts laid end to end."""
    empty = F.array().cast("array<struct<start:int,end:int>>")
    walked = F.aggregate(
        parts, F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.char_length(p["shown"])).alias("at"),
            F.when(p["train"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + p["skip"]).alias("start"), (acc["at"] + p["skip"] + p["said"]).alias("end")
            )))).otherwise(acc["spans"]).alias("spans"),
        ),
    )
    return walked["spans"]


def derived_pairs(turns: DataFrame) -> DataFrame:
    """(``pair_id``, ``chosen``, ``rejected``) made of given conversations, for want of judged
    ones: a conversation is chosen over itself with every turn of the assistant from a
    drawn one on replaced by what the assistant says in that place of the next
    conversation (the least of several texts), or by nothing where that has none.

    ``turns`` has ``conv_id`` (a whole number), ``turn``, ``role`` and ``text``.  Rows with a
    null conversation id are in no pair; a null turn is never replaced, and repeated rows are
    turns each.  An empty table gives an empty table; other columns are not looked at.

    Every turn is shuffled to its own conversation, and one of the assistant also to the
    conversation before; both are one exchange.
    """
    own = F.struct(F.col("turn").cast("bigint").alias("turn"), "role", "text")
    sent = F.array(F.struct(F.col("conv_id").cast("bigint").alias("to"), F.lit(True).alias("own")))
    least = F.col("conv_id") == F.lit(-(2**63))  # none before it
    also = F.when((F.col("role") == "assistant") & ~least, F.concat(
        sent, F.array(F.struct((F.col("conv_id") - 1).alias("to"), F.lit(False).alias("own")))
    )).otherwise(sent)
    gathered = turns.filter("conv_id IS NOT NULL").select(F.explode(also).alias("s"), own.alias("t")).groupBy(
        F.col("s.to").alias("pair_id")
    ).agg(
        F.collect_list(F.when(F.col("s.own"), F.col("t"))).alias("chosen"),
        F.collect_list(F.when(~F.col("s.own"), F.struct("t.turn", "t.text"))).alias("others"),
    ).filter(F.size("chosen") > 0)
    start = F.pmod(F.pmod("pair_id", F.size("chosen")) * 7, F.size("chosen"))

    def swapped(turn: Column) -> Column:
        there = F.filter("others", lambda o: (o["turn"] == turn["turn"]) & o["text"].isNotNull())
        other = F.coalesce(F.array_min(F.transform(there, lambda o: o["text"])), F.lit(""))
        changed = (turn["role"] == "assistant") & (turn["turn"] >= start)
        return F.struct(turn["turn"].alias("turn"), turn["role"].alias("role"), F.when(changed, other).otherwise(turn["text"]).alias("text"))

    return gathered.select("pair_id", "chosen", F.transform("chosen", swapped).alias("rejected"))


def op8_chat_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    made = format_pairs(derived_pairs(turns))
    as_text = {
        f"{side}_spans": F.array_join(F.transform(f"{side}_spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
        for side in SIDES
    }
    return made.withColumns(as_text)


def _sql_plain(x: str) -> str:
    return f"replace(replace(coalesce({x}, ''), '<|im_start|>', '< |im_start|>'), '<|im_end|>', '< |im_end|>')"


_SQL_HEAD = "'<|im_start|>' || " + _sql_plain(r"regexp_replace(coalesce(x.role, 'user'), '[\r\n]+', ' ', 'g')") + " || chr(10)"
_SQL_BODY = _sql_plain("x.text") + " || '<|im_end|>'"


def _sql_shown(turns: str) -> str:
    return f"""list_transform({turns}, lambda x: {{'shown': {_SQL_HEAD} || {_SQL_BODY} || chr(10), 'skip': length({_SQL_HEAD}),
        'said': length({_SQL_BODY}), 'train': coalesce(x.role, 'user') = 'assistant'}})"""


def _sql_spans(side: str) -> str:
    before = f"coalesce(list_sum(list_transform({side}_parts[1:i - 1], lambda y: length(y.shown))), 0) + {side}_parts[i].skip"
    one = f"CAST({before} AS VARCHAR) || ':' || CAST({before} + {side}_parts[i].said AS VARCHAR)"
    trained = f"list_filter(range(1, len({side}_parts) + 1), lambda i: {side}_parts[i].train)"
    return f"array_to_string(list_transform({trained}, lambda i: {one}), ',')"


def _sql_text(side: str) -> str:
    return f"array_to_string(list_transform({side}_parts, lambda y: y.shown), '')"


_SQL_ORDER = "ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST"
OP8_SQL = f"""
WITH known AS (SELECT * FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (SELECT conv_id, count(*) AS n FROM known GROUP BY conv_id),
others AS (SELECT conv_id - 1 AS conv_id, turn, min(text) AS other FROM known WHERE role = 'assistant' GROUP BY ALL),
sides AS (SELECT k.conv_id, k.turn, k.role, k.text, CASE WHEN role = 'assistant'
        AND k.turn >= ((k.conv_id % n + n) % n) * 7 % n THEN coalesce(other, '') ELSE text END AS changed
    FROM known k JOIN sizes USING (conv_id) LEFT JOIN others o ON o.conv_id = k.conv_id AND o.turn = k.turn),
lists AS (SELECT conv_id, list({{'role': role, 'text': text}} {_SQL_ORDER}) AS c,
        list({{'role': role, 'text': changed}} {_SQL_ORDER.replace('text', 'changed')}) AS r FROM sides GROUP BY conv_id),
cut AS (SELECT *, coalesce(list_min(list_filter(range(1, len(c) + 1), lambda i:
        c[i].role IS DISTINCT FROM r[i].role OR c[i].text IS DISTINCT FROM r[i].text)) - 1, len(c)) AS common FROM lists),
parts AS (SELECT conv_id, common, {_sql_shown('c[1:common]')} AS prompt_parts, {_sql_shown('c[common + 1:]')} AS chosen_parts,
        {_sql_shown('r[common + 1:]')} AS rejected_parts FROM cut),
done AS (SELECT conv_id AS pair_id, CAST(common AS BIGINT) AS common_turns, {_sql_text('prompt')} AS prompt,
        {_sql_text('chosen')} AS chosen, {_sql_text('rejected')} AS rejected,
        {_sql_spans('chosen')} AS chosen_spans, {_sql_spans('rejected')} AS rejected_spans FROM parts)
SELECT *, chosen_spans <> '' AND rejected_spans <> '' AND chosen <> rejected AS usable FROM done
"""
