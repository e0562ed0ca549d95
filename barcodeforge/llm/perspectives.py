"""Multi-party chat formatting: every dialogue once from the view of each of its speakers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barcodeforge.llm import common as C

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: speakers that take no part: their turns keep their role in every view and are never trained on
NARRATORS = ("system",)
#: turn numbers of one block; a block is what one window sorts
BLOCK = 256


def _clean_name(col: Column) -> Column:
    return F.regexp_replace(col, r"[\s<|>]+", "_")


def _clean_text(col: Column) -> Column:
    """A text cannot open or close a turn: marker strings in it get a space behind their bar."""
    return F.regexp_replace(col, r"<\|im_(start|end)\|>", "<| im_$1 |>")


def rotate_perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
                        text_col: str = "text", narrators: tuple[str, ...] = NARRATORS) -> DataFrame:
    """Render every conversation once for each participant, with that speaker as ``assistant``
    and all others as named users; one row per view and turn.

    Returns ``conv_id, perspective, turn, speaker, role, name, rendered, loss_mask, seg_start,
    seg_end, train_start, train_end``. Joining ``rendered`` in order of ``seg_start`` gives the
    whole view; ``[seg_start, seg_end)`` are code points in it. Tokens are trained on in
    ``[train_start, train_end)``: the text and the closing marker of the assistant's own turns;
    both are null elsewhere and ``loss_mask`` is 0.

    Turns are ordered by ``(turn, speaker, text)``, nulls first, so ties and repeated rows have
    a place of their own. A null speaker is "unknown", a null text empty. A conversation with
    narrators only has no view. Other columns are ignored.

    A conversation may hold a third of all rows: no window or join sees one conversation whole.
    Turns are cut into blocks of 256 turn numbers; the offsets of the blocks come from a small
    pre-aggregated table (one row per block and view), and each block is sorted on its own.
    """
    speaker = F.coalesce(F.col(speaker_col).cast("string"), F.lit("unknown"))
    base = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), speaker.alias("speaker"),
                        _clean_text(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("body"))
    narrator = F.col("speaker").isin(*narrators) if narrators else F.lit(False)
    base = base.withColumns({
        "block": F.coalesce(F.floor(F.col("turn") / BLOCK).cast("bigint"), F.lit(-(1 << 62))),
        "name": _clean_name(F.col("speaker")), "narrator": narrator})
    frame = len(OPEN) + 1 + len(CLOSE) + 1
    # length of a turn as it is when its speaker is not the assistant of the view
    other = F.length("body") + frame + F.length("name") + F.when(F.col("narrator"), 0).otherwise(len("user name="))
    sums = (base.groupBy("conv_id", "block", "speaker", "name", "narrator")
            .agg(F.sum(other.cast("bigint")).alias("chars"), F.count("*").alias("own")))
    sums = C.stage_table(sums)
    blocks = sums.groupBy("conv_id", "block").agg(F.sum("chars").alias("chars"))
    people = sums.where("not narrator").select("conv_id", F.col("speaker").alias("perspective"),
                                               F.col("name").alias("view_name")).distinct()
    own = sums.where("not narrator").select("conv_id", "block", F.col("speaker").alias("perspective"), "own")
    shorter = F.lit(len("assistant") - len("user name=")) - F.length("view_name")
    views = (_on(blocks, people, ["conv_id"]).transform(lambda d: _on(d, own, ["conv_id", "block", "perspective"], "left"))
             .withColumn("chars", F.col("chars") + shorter * F.coalesce("own", F.lit(0))))
    before = Window.partitionBy("conv_id", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    views = views.withColumn("first", F.coalesce(F.sum("chars").over(before), F.lit(0)))
    views = views.groupBy("conv_id", "block").agg(F.collect_list(F.struct("perspective", "first")).alias("views"))
    rows = _on(base, views, ["conv_id", "block"]).withColumn("view", F.explode("views")).select(
        "conv_id", "block", "turn", "speaker", "name", "narrator", "body", "view.perspective", "view.first")
    mine = F.col("speaker") == F.col("perspective")
    role = F.when(F.col("narrator"), F.col("name")).when(mine, F.lit("assistant")).otherwise(F.lit("user"))
    user_name = F.when(role == "user", F.when(~F.col("narrator") & ~mine, F.col("name")))
    head = F.concat(F.lit(OPEN), role, F.when(user_name.isNotNull(), F.concat(F.lit(" name="), user_name)).otherwise(""),
                    F.lit("\n"))
    rows = rows.withColumns({"own_role": role, "user_name": user_name,
                             "rendered": F.concat(head, F.col("body"), F.lit(CLOSE + "\n"))})
    rows = rows.withColumn("size", F.length("rendered").cast("bigint"))
    order = (Window.partitionBy("conv_id", "block", "perspective").orderBy("turn", "speaker", "body")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("seg_end", F.col("first") + F.sum("size").over(order))
    trained = (F.col("own_role") == "assistant") & ~F.col("narrator")
    return rows.select(
        "conv_id", "perspective", "turn", "speaker", F.col("own_role").alias("role"), F.col("user_name").alias("name"),
        "rendered", trained.cast("int").alias("loss_mask"), (F.col("seg_end") - F.col("size")).alias("seg_start"), "seg_end",
        F.when(trained, F.col("seg_end") - F.col("size") + len(OPEN + "assistant\n")).alias("train_start"),
        F.when(trained, F.col("seg_end") - 1).alias("train_end"))


def _on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null conversation ids are equal too."""
    renamed = right.select(*[F.col(k).alias(f"r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    condition = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"r_{k}"))
        condition = one if condition is None else condition & one
    return left.join(renamed, condition, how).drop(*[f"r_{k}" for k in keys])


def op8(spark, sf_dir: str) -> DataFrame:
    return rotate_perspectives(C.table(spark, sf_dir, "conversations"))


ORACLE = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker,
         regexp_replace(coalesce(text, ''), '<\\|im_(start|end)\\|>', '<| im_\\1 |>', 'g') AS body
  FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
v AS (
  SELECT t.conv_id, p.perspective, t.turn, t.speaker, t.body,
         CASE WHEN t.speaker = 'system' THEN 'system' WHEN t.speaker = p.perspective THEN 'assistant' ELSE 'user' END AS role,
         CASE WHEN t.speaker <> 'system' AND t.speaker <> p.perspective
              THEN regexp_replace(t.speaker, '[\\s<|>]+', '_', 'g') END AS name
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
r AS (
  SELECT *, '<|im_start|>' || role || CASE WHEN name IS NULL THEN '' ELSE ' name=' || name END || chr(10)
            || body || '<|im_end|>' || chr(10) AS rendered FROM v),
e AS (
  SELECT *, CAST(sum(length(rendered)) OVER (PARTITION BY conv_id, perspective
            ORDER BY turn NULLS FIRST, speaker, body ROWS UNBOUNDED PRECEDING) AS BIGINT) AS seg_end FROM r)
SELECT conv_id, perspective, turn, speaker, role, name, rendered,
       CASE WHEN role = 'assistant' THEN 1 ELSE 0 END AS loss_mask,
       seg_end - length(rendered) AS seg_start, seg_end,
       CASE WHEN role = 'assistant' THEN seg_end - length(rendered) + 22 END AS train_start,
       CASE WHEN role = 'assistant' THEN seg_end - 1 END AS train_end
FROM e
"""
