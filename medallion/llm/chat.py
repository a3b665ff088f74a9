"""Preference formatting of paired conversations.

The longest common turn prefix of the chosen and the rejected conversation is rendered once, as the prompt; what
follows it is rendered for each side, as its completion. The result has one row per rendered turn, so a conversation
that holds a large share of all turns is spread like any other; read in the order of ``turn``, the rows of a part
give its text.

A turn is rendered as a header and a body. Headers and prompts are masked; ``trained`` holds for the bodies of the
assistant in completions.

Defined results
* Turns are equal when role and text are equal, NULL being equal to NULL. The prefix ends before the first turn
  number at which the sides differ or only one of them has a turn.
* Pairs of which one side has no turn are left out. Sides that are equal have a prompt and no completion.
* Of rows that repeat a pair, side and turn the smallest role and text stay. Rows without a pair or a turn are left
  out. A NULL role is rendered as ``unknown``, a NULL text as nothing. Other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROMPT, CHOSEN, REJECTED = "prompt", "chosen", "rejected"
TRAINED_ROLE = "assistant"


def preference_turns(turns: DataFrame) -> DataFrame:
    """pair_id, part, turn, role, header, body and trained, from ``turns`` (pair_id, side, turn, role, text)."""
    known = turns.where(F.col("pair_id").isNotNull() & F.col("turn").isNotNull() & F.col("side").isin(CHOSEN, REJECTED))
    said = F.struct("role", "text")
    # Both sides of a turn meet in one row; merged before the shuffle, without a join.
    met = known.groupBy("pair_id", "turn").agg(
        *[F.min(F.when(F.col("side") == side, said)).alias(side) for side in (CHOSEN, REJECTED)]
    )
    differ = ~F.col(CHOSEN).eqNullSafe(F.col(REJECTED))
    splits = (
        met.groupBy("pair_id")
        .agg(
            F.min(F.when(differ, F.col("turn"))).alias("split"),
            *[F.count(side).alias(f"n_{side}") for side in (CHOSEN, REJECTED)],
        )
        .where(f"n_{CHOSEN} > 0 AND n_{REJECTED} > 0")
        .select("pair_id", "split")
    )
    common = F.col("split").isNull() | (F.col("turn") < F.col("split"))

    def part(name: str, side: str):
        return F.struct(F.lit(name).alias("part"), F.col(f"{side}.role").alias("role"), F.col(f"{side}.text").alias("text"))

    completions = F.filter(
        F.array(*[F.when(F.col(side).isNotNull(), part(side, side)) for side in (CHOSEN, REJECTED)]),
        lambda said: said.isNotNull(),
    )
    parts = F.when(common, F.array(part(PROMPT, CHOSEN))).otherwise(completions)
    rows = met.join(splits, "pair_id").select("pair_id", "turn", F.explode(parts).alias("said"))
    role = F.coalesce("said.role", F.lit("unknown"))
    return rows.select(
        "pair_id",
        "said.part",
        "turn",
        role.alias("role"),
        F.concat(F.lit("<|"), role, F.lit("|>\n")).alias("header"),
        F.concat(F.coalesce("said.text", F.lit("")), F.lit("<|end|>\n")).alias("body"),
        ((F.col("said.part") != PROMPT) & (role == TRAINED_ROLE)).alias("trained"),
    )


def answer_pairs(conversations: DataFrame) -> DataFrame:
    """Every conversation as the chosen side of the pair that has its id. Rejected are the same turns with the last
    answer that the assistant of conversation ``conv_id ^ 1`` gave in place of the last one here; where there is none,
    the turns without it. Rows without a conversation or a turn are left out; of an answer's texts the greatest counts.

    Answers are joined by conversation, one row each, and turns by conversation and turn, so a conversation that holds
    a large share of all turns is spread.
    """
    known = conversations.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    known = known.select(F.col("conv_id").cast("long").alias("pair_id"), "turn", "role", "text")
    answers = known.where(F.col("role") == TRAINED_ROLE).groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    other = answers.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("last.text").alias("text"))
    swapped = answers.select("pair_id", F.col("last.turn").alias("turn"), F.lit(TRAINED_ROLE).alias("role")).join(other, "pair_id")
    kept = known.join(answers.select("pair_id", F.col("last.turn").alias("turn")), ["pair_id", "turn"], "left_anti")

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select("pair_id", F.lit(name).alias("side"), "turn", "role", "text")

    return side(known, CHOSEN).unionByName(side(kept, REJECTED)).unionByName(side(swapped, REJECTED))


CHAT_SQL = """
WITH known AS (
  SELECT conv_id AS pair_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), answers AS (
  SELECT pair_id, max(turn) AS turn FROM known WHERE role = 'assistant' GROUP BY pair_id
), last_texts AS (
  SELECT pair_id, turn, max(text) AS text FROM known JOIN answers USING (pair_id, turn) WHERE role = 'assistant' GROUP BY ALL
), sides AS (
  SELECT pair_id, 0 AS side, turn, role, text FROM known
  UNION ALL SELECT pair_id, 1, turn, role, text FROM known ANTI JOIN answers USING (pair_id, turn)
  UNION ALL SELECT a.pair_id, 1, a.turn, 'assistant', b.text FROM last_texts a JOIN last_texts b ON xor(a.pair_id, 1) = b.pair_id
), said AS (
  SELECT pair_id, side, turn, min(struct_pack(role := role, text := text)) AS said FROM sides GROUP BY ALL
), met AS (
  SELECT pair_id, turn, max(said) FILTER (side = 0) AS chosen, max(said) FILTER (side = 1) AS rejected
  FROM said GROUP BY ALL
), splits AS (
  SELECT pair_id, min(turn) FILTER (chosen IS DISTINCT FROM rejected) AS split FROM met GROUP BY pair_id
  HAVING count(chosen) > 0 AND count(rejected) > 0
), parts AS (
  SELECT pair_id, 'prompt' AS part, turn, chosen AS said FROM met JOIN splits USING (pair_id)
  WHERE split IS NULL OR turn < split
  UNION ALL SELECT pair_id, 'chosen', turn, chosen FROM met JOIN splits USING (pair_id)
  WHERE turn >= split AND chosen IS NOT NULL
  UNION ALL SELECT pair_id, 'rejected', turn, rejected FROM met JOIN splits USING (pair_id)
  WHERE turn >= split AND rejected IS NOT NULL
)
SELECT pair_id, part, turn, coalesce(said.role, 'unknown') AS role,
  '<|' || coalesce(said.role, 'unknown') || '|>' || chr(10) AS header,
  coalesce(said.text, '') || '<|end|>' || chr(10) AS body,
  part != 'prompt' AND coalesce(said.role, 'unknown') = 'assistant' AS trained
FROM parts
"""
