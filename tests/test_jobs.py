import pytest

from toxiscope.plans.jobs import score_job, train_job

ROWS = [
    ("a{}", "thanks for the edit page", 0, 0, 0, 0, 0, 0),
    ("b{}", "you rude idiot hate", 1, 0, 1, 0, 1, 0),
    ("c{}", "see the talk source article", 0, 0, 0, 0, 0, 0),
    ("d{}", "stupid awful idiot", 1, 1, 0, 0, 1, 0),
]


def _csv(path, n):
    lines = ["id,clean_comment,toxic,severe_toxic,obscene,threat,insult,identity_hate"]
    for i in range(n):
        for r in ROWS:
            vals = [r[0].format(i), '"' + r[1] + '"', *map(str, r[2:])]
            lines.append(",".join(vals))
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_train_then_score(spark, tmp_path):
    train = _csv(tmp_path / "train.csv", 30)
    test = _csv(tmp_path / "test.csv", 5)
    models = str(tmp_path / "models")
    for label in ("toxic", "insult"):
        res = train_job(spark, train, test, label, out=str(tmp_path / f"m_{label}"), kind="nb",
                        model_dir=models, labels=["toxic", "insult"])
        f1 = {(r.metric, r["class"]): r.value for r in res.metrics.collect()}[("f1", 1)]
        assert f1 == pytest.approx(1.0)
    assert spark.read.parquet(str(tmp_path / "m_toxic")).count() == 11
    msgs = tmp_path / "msgs"
    msgs.mkdir()
    (msgs / "1.txt").write_text("rude idiot")
    (msgs / "2.txt").write_text("thanks for the edit")
    out = score_job(spark, str(msgs), models, str(tmp_path / "scores"), kind="nb", labels=["toxic", "insult"])
    got = {(r.label, r.prediction) for r in out.collect()}
    assert ("toxic", 1) in got and ("toxic", 0) in got


def test_text_metrics_sink_refuses_existing(spark, tmp_path):
    train = _csv(tmp_path / "train.csv", 10)
    out = str(tmp_path / "txt")
    train_job(spark, train, train, "toxic", out=out, text_output=True, labels=["toxic"])
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert any(l.startswith("(f1,") and " | " in l for l in lines)
    with pytest.raises(Exception):
        train_job(spark, train, train, "toxic", out=out, text_output=True, labels=["toxic"])


def test_unknown_label_rejected(spark, tmp_path):
    train = _csv(tmp_path / "train.csv", 2)
    with pytest.raises(ValueError):
        train_job(spark, train, train, "nope")


def test_profile_job(spark, tmp_path):
    from toxiscope.plans.jobs import profile_job

    path = _csv(tmp_path / "p.csv", 1)
    frames = profile_job(spark, path, out=str(tmp_path / "prof"))
    dist = {r.label: r.positives for r in frames["distribution"].collect()}
    assert dist == {"toxic": 2, "severe_toxic": 1, "obscene": 1, "threat": 0, "insult": 2, "identity_hate": 0}
    assert frames["tagged"].first().share == 0.5
    assert spark.read.parquet(str(tmp_path / "prof" / "correlation")).count() == 15
    assert frames["quality"].first().null_toxic == 0


def test_columns_are_found_by_name_and_extra_ones_dropped(spark, tmp_path):
    from toxiscope.sources.readers import label_quality, read_comments

    p = tmp_path / "c.csv"
    p.write_text(
        "identity_hate,extra,clean_comment,insult,id,threat,obscene,severe_toxic,toxic\n"
        '0,x,"you, idiot",1,a,0,0,0,1\n0,y,,0,b,0,0,0,\n0,z,fine,0,c,0,0,0,nan\n0,z,odd,0,d,0,0,0,7\n'
    )
    df = read_comments(spark, str(p))
    rows = {r.id: r for r in df.collect()}
    assert rows["a"].toxic == 1 and rows["a"].identity_hate == 0 and rows["a"].clean_comment == "you, idiot"
    assert rows["b"].clean_comment == "" and rows["b"].toxic is None and rows["c"].toxic is None
    q = label_quality(df, ["toxic", "insult"]).first()
    assert (q.rows, q.empty_text, q.null_toxic, q.other_toxic, q.null_insult) == (4, 1, 2, 1, 0)
    (tmp_path / "bad.csv").write_text("id,clean_comment\na,b\n")
    with pytest.raises(ValueError):
        read_comments(spark, str(tmp_path / "bad.csv"))


def test_six_networks_train_save_load_score(spark, tmp_path):
    from toxiscope.plans.jobs import train_all_job
    from toxiscope.schema import LABELS

    train, models = _csv(tmp_path / "train.csv", 30), str(tmp_path / "m")
    results = train_all_job(spark, train, train, kind="mlp", model_dir=models, feature_params={"w2v_min_count": 1})
    assert set(results) == set(LABELS)
    assert results["threat"].model is None and results["toxic"].model is not None  # threat has no positive row
    msgs = tmp_path / "msgs"
    msgs.mkdir()
    (msgs / "1.txt").write_text("rude idiot hate")
    (msgs / "2.txt").write_text("")
    out = score_job(spark, str(msgs), models).collect()
    assert len(out) == 2 * len(LABELS)
    assert all((r.prediction is None) == (results[r.label].model is None) for r in out)


def test_model_folder_keeps_one_feature_chain_per_kind(spark, tmp_path):
    train, models = _csv(tmp_path / "train.csv", 20), str(tmp_path / "m")
    train_job(spark, train, train, "toxic", kind="nb", model_dir=models)
    train_job(spark, train, train, "insult", kind="svm", model_dir=models, feature_kind="tfidf", num_folds=0)
    msgs = tmp_path / "msgs"
    msgs.mkdir()
    (msgs / "1.txt").write_text("rude idiot hate")
    a = score_job(spark, str(msgs), models, kind="nb", labels=["toxic"]).first()
    b = score_job(spark, str(msgs), models, kind="svm", labels=["insult"], feature_kind="tfidf").first()
    assert a.prediction == 1 and b.prediction == 1


def test_network_has_a_default_method(spark, tmp_path):
    train = _csv(tmp_path / "train.csv", 20)
    res = train_job(spark, train, train, "toxic", kind="mlp", feature_params={"w2v_min_count": 1})
    assert res.method == "none" and res.model is not None
