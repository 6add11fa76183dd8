"""Pairs of a chosen and a rejected conversation as one prompt and two completions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import query, table


@dataclass(frozen=True)
class Template:
    """How a turn is written, and whose turns are learned."""

    before_role: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>\n"
    learned: str = "assistant"


def placed(turns: DataFrame) -> DataFrame:
    """Turns (pair, turn, role, text) numbered from 1 within their pair; ties go by content."""
    order = Window.partitionBy("pair").orderBy("turn", "role", "text")
    return turns.select("pair", "role", "text", F.row_number().over(order).alias("at"))


def preference_pairs(
    chosen: DataFrame, rejected: DataFrame, template: Template = Template()
) -> DataFrame:
    """One row per pair: pair, prompt_turns, prompt, chosen, rejected and their spans.

    Both inputs hold turns (pair, turn, role, text). The prompt is the longest run of
    equal turns (role and text, nulls equal) from the start, written once. Each
    completion is the rest of its conversation; its spans (``start-end`` in characters,
    joined by commas) are what is learned: text and end mark of the learned role's
    turns; all else is masked. Equal conversations give two empty completions, a pair
    that one side lacks an empty prompt and an empty completion for it. Null roles and
    texts are written as empty; turns with a null pair form one pair.
    """
    a, b = placed(chosen), placed(rejected)
    left = a.select("pair", "at", F.struct("role", "text").alias("c"))
    right = b.select(
        F.col("pair").alias("pair_r"), F.col("at").alias("at_r"), F.struct("role", "text").alias("r")
    )
    both = left.join(
        right, left["pair"].eqNullSafe(right["pair_r"]) & (F.col("at") == F.col("at_r")), "full"
    )
    place = F.coalesce("at", "at_r")
    equal = (
        F.col("at").isNotNull()
        & F.col("at_r").isNotNull()
        & F.col("c.role").eqNullSafe(F.col("r.role"))
        & F.col("c.text").eqNullSafe(F.col("r.text"))
    )
    both = both.select(
        F.when(F.col("at").isNotNull(), F.col("pair")).otherwise(F.col("pair_r")).alias("pair"),
        place.alias("at"),
        "c",
        "r",
        F.col("at").isNotNull().alias("in_c"),
        F.col("at_r").isNotNull().alias("in_r"),
        equal.alias("equal"),
    )
    from_start = Window.partitionBy("pair").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("shared", F.min(F.col("equal").cast("int")).over(from_start) == 1)

    def written(turn: str) -> Column:
        return F.concat(
            F.lit(template.before_role),
            F.coalesce(F.col(f"{turn}.role"), F.lit("")),
            F.lit(template.after_role),
            F.coalesce(F.col(f"{turn}.text"), F.lit("")),
            F.lit(template.end),
        )

    both = both.withColumns({
        "wc": F.when(F.col("in_c"), written("c")),
        "wr": F.when(F.col("in_r"), written("r")),
    })

    def span(turn: str, text: str) -> Column:
        """Where the learned part of a turn lies in its completion, else null."""
        length = F.when(~F.col("shared"), F.length(text))
        end = F.sum(length).over(from_start)
        body = F.length(F.coalesce(F.col(f"{turn}.text"), F.lit(""))) + F.length(F.lit(template.end))
        return F.when(
            ~F.col("shared") & (F.col(f"{turn}.role") == template.learned),
            F.concat((end - body).cast("string"), F.lit("-"), end.cast("string")),
        )

    both = both.withColumns({"sc": span("c", "wc"), "sr": span("r", "wr")})

    def joined(value: str, when: Column | None = None, by: str = "") -> Column:
        item = F.struct("at", F.col(value).alias("v"))
        keep = F.col(value).isNotNull() if when is None else when & F.col(value).isNotNull()
        rows = F.array_sort(F.collect_list(F.when(keep, item)))
        return F.array_join(F.transform(rows, lambda x: x["v"]), by)

    return both.groupBy("pair").agg(
        F.sum(F.col("shared").cast("long")).alias("prompt_turns"),
        joined("wc", F.col("shared")).alias("prompt"),
        joined("wc", ~F.col("shared")).alias("chosen"),
        joined("wr", ~F.col("shared")).alias("rejected"),
        joined("sc", by=",").alias("chosen_spans"),
        joined("sr", by=",").alias("rejected_spans"),
    )


def answer_swaps(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Preference pairs out of plain conversations: each conversation is chosen as it is;
    rejected is the same with its last assistant text taken from the neighbour, the
    conversation whose id differs in the lowest bit (empty if it has none)."""
    rows = turns.select(F.col("conv_id").alias("pair"), "turn", "role", "text")
    last = (
        rows.where(F.col("role") == "assistant")
        .groupBy("pair")
        .agg(F.max(F.struct("turn", "text")).alias("last"))
        .select("pair", F.col("last.turn").alias("last_turn"), F.col("last.text").alias("last_text"))
    )
    other = last.select(
        F.col("pair").bitwiseXOR(F.lit(1)).alias("pair"), F.col("last_text").alias("other_text")
    )
    marks = last.select("pair", "last_turn").join(other, "pair", "left")
    swapped = rows.join(marks, "pair", "left").select(
        "pair",
        "turn",
        "role",
        F.when(
            (F.col("role") == "assistant") & (F.col("turn") == F.col("last_turn")),
            F.coalesce("other_text", F.lit("")),
        )
        .otherwise(F.col("text"))
        .alias("text"),
    )
    return rows, swapped


@query(
    "op9_preference_pairs",
    """
WITH last AS (SELECT conv_id, max(turn) AS last_turn, arg_max(text, turn) AS last_text
              FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
c AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS a
      FROM conversations),
s AS (SELECT v.conv_id, v.turn, v.role,
        CASE WHEN v.role = 'assistant' AND v.turn = l.last_turn THEN coalesce(o.last_text, '') ELSE v.text END AS text
      FROM conversations v LEFT JOIN last l USING (conv_id) LEFT JOIN last o ON o.conv_id = xor(v.conv_id, 1)),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS a FROM s),
b AS (SELECT c.conv_id, c.a, c.role AS cr, c.text AS ct, r.role AS rr, r.text AS rt,
        min((c.role = r.role AND c.text = r.text)::int) OVER (PARTITION BY c.conv_id ORDER BY c.a) = 1 AS shared
      FROM c JOIN r ON c.conv_id = r.conv_id AND c.a = r.a),
w AS (SELECT *, '<|im_start|>' || cr || chr(10) || ct || '<|im_end|>' || chr(10) AS wc,
        '<|im_start|>' || rr || chr(10) || rt || '<|im_end|>' || chr(10) AS wr FROM b),
e AS (SELECT *, sum(CASE WHEN NOT shared THEN length(wc) END) OVER (PARTITION BY conv_id ORDER BY a) AS ec,
        sum(CASE WHEN NOT shared THEN length(wr) END) OVER (PARTITION BY conv_id ORDER BY a) AS er FROM w)
SELECT conv_id AS pair, sum(shared::int)::bigint AS prompt_turns,
  coalesce(string_agg(wc, '' ORDER BY a) FILTER (shared), '') AS prompt,
  coalesce(string_agg(wc, '' ORDER BY a) FILTER (NOT shared), '') AS chosen,
  coalesce(string_agg(wr, '' ORDER BY a) FILTER (NOT shared), '') AS rejected,
  coalesce(string_agg((ec - length(ct) - 11)::varchar || '-' || ec::varchar, ',' ORDER BY a)
    FILTER (NOT shared AND cr = 'assistant'), '') AS chosen_spans,
  coalesce(string_agg((er - length(rt) - 11)::varchar || '-' || er::varchar, ',' ORDER BY a)
    FILTER (NOT shared AND rr = 'assistant'), '') AS rejected_spans
FROM e GROUP BY conv_id""",
)
def preference_pairs_of_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation against itself with another last answer."""
    return preference_pairs(*answer_swaps(table(spark, folder, "conversations")))
