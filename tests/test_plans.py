"""Plan checks: the physical plans use the strategies the design relies on."""

from yardstick.plans import chat, evaluation, sampling


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parse_has_no_python(spark, sf_small):
    p = _plan(evaluation.q_extract_predictions(spark, sf_small))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_parse_scan_is_pruned(spark, sf_small):
    p = evaluation.q_eval_metrics(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint>" in p or "struct<doc_id:bigint>" in p


def test_stratified_sample_limits_before_shuffle(spark, sf_small):
    df = sampling.q_stratified_sample(spark, sf_small)
    p = df._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in p


def test_rules_lookup_is_broadcast(spark, sf_small):
    p = _plan(chat.q_reasoning_text(spark, sf_small))
    assert "Broadcast" in p


def test_dedup_aggregates_partially(spark, sf_small):
    p = _plan(evaluation.q_eval_metrics(spark, sf_small))
    assert "partial_max_by" in p or "partial_" in p


def _conversations_to_messages(conv):
    """Nested form for the cross-check only: one row per conversation (small data)."""
    from pyspark.sql import functions as F

    item_text = F.struct(F.lit("text").alias("type"), F.col("text").alias("text"), F.lit(None).cast("binary").alias("image"))
    item_img = F.struct(F.lit("image").alias("type"), F.lit(None).cast("string").alias("text"), F.encode("text", "UTF-8").alias("image"))
    content = F.when(F.col("turn") % 3 == 2, F.array(item_text, item_img)).otherwise(F.array(item_text))
    turns = conv.select("conv_id", "turn", F.struct(F.col("role"), content.alias("content")).alias("m"))
    grouped = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "m"))).alias("_t"))
    return grouped.select("conv_id", F.transform("_t", lambda x: x["m"]).alias("messages"))


def test_nested_and_flat_image_order_agree(spark, sf_small):
    from pyspark.sql import functions as F

    from yardstick.functions import chat as C
    from yardstick.operators import chat as CH
    from yardstick.sources import derived

    conv = derived.read_table(spark, sf_small, "conversations")
    nested = _conversations_to_messages(conv).select(
        "conv_id", F.posexplode(C.message_images("messages")).alias("pos", "image")
    )
    flat = CH.conversation_images(conv).select("conv_id", "pos", "image")
    a = sorted((r.conv_id, r.pos, bytes(r.image)) for r in nested.collect())
    b = sorted((r.conv_id, r.pos, bytes(r.image)) for r in flat.collect())
    assert a == b and len(a) > 0


def test_filters_do_not_repeat_the_parse(spark, sf_small):
    from yardstick.operators import extract
    from yardstick.sources import derived

    rp = extract.raw_predictions(derived.raw_output_lines(spark, sf_small), derived.RAW_PREFIX)
    plan = rp._jdf.queryExecution().optimizedPlan().toString()
    filters = [ln for ln in plan.splitlines() if ln.strip().startswith(("Filter", "+- Filter", ":- Filter"))]
    assert filters and not any("try_variant_get" in ln or "parse_json" in ln for ln in filters)


def test_scorer_runs_once_per_query(spark, sf_small):
    # per-sample rows and the reasoning table come from one projection: one scoring node
    from yardstick.plans import io

    for q in (io.q_sample_predictions,):
        plan = q(spark, sf_small)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInPandas") <= 1
    from yardstick.plans import scoring

    p = scoring.q_online_metrics(spark, sf_small)
    p._jdf.queryExecution().toRdd().count()
    final = p._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("MapInPandas") == 1
