"""Plan-shape regressions: the shuffles and pushdowns the design relies on."""

import re

import __spark_entry__ as E

from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(plan):
    return re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)\(?([a-z_]*)", plan)


def test_term_counts_reuse_document_partitioning(spark):
    df = E.queries()["term_counts"](spark, SF_SMALL)
    assert [c for _, c in _exchanges(_plan(df))] == ["doc_id"]  # only the spread of the scan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in _formatted(df)  # 2 of 5 columns read


def test_nb_scoring_never_shuffles_tokens(spark):
    plan = _plan(E.queries()["nb_predict"](spark, SF_SMALL))
    assert "hashpartitioning(term" not in plan
    assert "BroadcastHashJoin" in plan


def test_training_frame_scans_are_pruned_and_filtered(spark):
    df = E.queries()["training_frame"](spark, SF_SMALL)
    text = df._jdf.queryExecution().toString()
    assert "ReadSchema: struct<doc_id:bigint,quality:int,toxic:int>" in _formatted(df)
    assert "Or(IsNotNull(toxic),IsNotNull(quality))" in _formatted(df)
    assert "Union" not in text


def test_tfidf_tokenizes_once(spark):
    df = E.queries()["tfidf"](spark, SF_SMALL)
    plan = _plan(df)
    assert "Generate" not in plan and "documents" not in plan  # both uses read the written counts


def test_label_queries_read_labels_only(spark):
    for name in ("label_distribution", "tagged_share", "label_correlation", "hash_split", "class_weights", "undersample",
                 "oversample"):
        text = _formatted(E.queries()[name](spark, SF_SMALL))
        assert "documents" not in text and "labels.parquet" in text


def test_oversample_plans_without_running_its_input(spark):
    from toxiscope.operators.balance import oversample

    df = spark.createDataFrame([(i, int(i < 3)) for i in range(30)], "doc_id long, toxic int")
    group = "oversample-plan"
    spark.sparkContext.setJobGroup(group, group)
    out = oversample(df, "toxic", "doc_id", counts=(30, 3))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 0 and out.where("toxic = 1").count() == 27


def test_nb_beyond_the_budget_shuffles_counts_not_tokens(spark):
    from toxiscope.operators.naive_bayes import NBRun, nb_fit, nb_predict
    from toxiscope.plans.prepared import labelled_documents, split_parts

    train, test = split_parts(labelled_documents(spark, SF_SMALL))
    model = nb_fit(train, [NBRun("m", "toxic")], text_col="clean_comment")
    plan = _plan(nb_predict(model, test, "doc_id", text_col="clean_comment", broadcast_max_bytes=0))
    for part in plan.split("hashpartitioning(term")[1:]:
        assert "HashAggregate(keys=[doc_id" in part or "Scan" in part


def test_metrics_are_one_small_aggregate(spark):
    plan = _plan(E.queries()["class_metrics"](spark, SF_SMALL))
    assert "hashpartitioning(term" not in plan
    assert "SortAggregate" not in plan


def _formatted(df):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()
