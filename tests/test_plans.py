"""Plan-shape regressions: shuffles, scans and pushdown of the key jobs."""

import re
from contextlib import contextmanager

import pytest

from icdspark.operators import metrics as me
from icdspark.operators import roc
from icdspark.plans.etl import proxy_etl
from icdspark.plans.prepare import prepared
from icdspark.sources.proxy import ProxyTables

SF = "/root/testdata/sf0.001"


@contextmanager
def static_plans(spark, broadcast=False):
    """Plans as they are before run time, without broadcasts unless asked for."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def depth(line):
    return len(re.match(r"[\s:|+\-*()\d]*", line).group(0))


def below(plan, pattern):
    """The lines under the first line that matches."""
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if re.search(pattern, line))
    out = []
    for line in lines[at + 1 :]:
        if depth(line) <= depth(lines[at]):
            break
        out.append(line)
    return out


def shuffles(plan):
    return re.findall(r"(?<!Reused)Exchange (?:hash|range)partitioning\(([^)]*)\)", plan)


def scans(plan):
    return plan.count("FileScan parquet")


def test_labelled_admissions_shuffle_each_input_once(spark):
    with static_plans(spark, broadcast=True):
        plan = plan_of(proxy_etl(spark, SF).labelled())
    assert len(shuffles(plan)) == 2, plan


def test_notes_are_cleaned_before_the_shuffle(spark):
    with static_plans(spark):
        plan = plan_of(proxy_etl(spark, SF).labelled())
    text_exchange = below(plan, r"Exchange hashpartitioning\(subject_id")
    assert any("regexp_replace" in line for line in text_exchange), plan


def test_scans_read_only_what_is_used(spark):
    plan = proxy_etl(spark, SF).labelled()._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)", plan)
    read = {c.split(":")[0] for schema in schemas for c in schema.split(",") if ":" in c}
    assert read == {
        "doc_id", "text", "lang", "o_orderkey", "o_custkey", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"}


def test_split_moves_no_text_again(spark):
    with static_plans(spark):
        etl = proxy_etl(spark, SF)
        plan = plan_of(etl.split())
    # every exchange under which the cleaned text is aggregated already would move it a second time
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            inner = [x for x in lines[i + 1 : i + 4]]
            assert not any("collect_list" in x and "partial" not in x for x in inner), plan


def test_admission_keys_need_no_text(spark):
    plan = plan_of(proxy_etl(spark, SF).admission_keys())
    assert "regexp_replace(text" not in plan and "text:string" not in plan


def test_windows_without_partition_run_over_totals_only(spark):
    tail = re.compile(r"\) AS [^\],]+\], \[([^\]]*)\]$")
    for df in (proxy_etl(spark, SF).assignment(), roc.micro_auc(ProxyTables(spark, SF).pred())):
        alone = [
            line for line in plan_of(df).split("\n")
            if "Window [" in line and (m := tail.search(line.strip())) and ("ASC" in m.group(1) or "DESC" in m.group(1))
        ]
        assert all("__tot_" in line for line in alone), alone


def test_running_sums_window_the_rows_once(spark):
    with static_plans(spark):
        plan = plan_of(roc.roc_points(ProxyTables(spark, SF).pred()))
    rows = [line for line in plan.split("\n") if "Window [" in line and "score#" in line]
    assert len(rows) == 1 and scans(plan) == 1, plan


def test_report_and_macro_curve_are_bounded(spark):
    pred = ProxyTables(spark, SF).pred()
    with static_plans(spark):
        report, macro = plan_of(me.evaluation_report(pred)), plan_of(roc.macro_roc_area(pred))
    assert scans(report) <= 3, report
    assert len(shuffles(macro)) <= 16 and scans(macro) <= 2, macro


def test_building_a_query_runs_no_job(spark):
    pred, etl = ProxyTables(spark, SF).pred(), proxy_etl(spark, SF)  # reading a table's schema is a job
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "no job may run")
    try:
        roc.macro_roc_area(pred), me.evaluation_report(pred), etl.split()
        assert not [j for j in tracker.getJobIdsForGroup("building")]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_encoding_shuffles_documents_not_tokens(spark):
    p = prepared(spark, SF)
    p.split_adm, p.label_index, p.word_index, p.num_words  # written before the plan is looked at
    with static_plans(spark, broadcast=True):
        keys = shuffles(plan_of(p.encoded()))
    assert keys and all(k.startswith("subject_id") for k in keys), keys


def test_batches_are_numbered_without_their_lists(spark):
    p = prepared(spark, SF)
    with static_plans(spark):
        plan = plan_of(p.batched())
    lines = plan.split("\n")
    ranked = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning(split#" in line]
    assert ranked and all("AS word_ids#" not in line and "collect" not in line for line in ranked), ranked


@pytest.mark.parametrize("name", ["g01_group_split", "f19_macro_roc_area", "i05_encode_documents"])
def test_no_python_in_the_plans(spark, name):
    from icdspark.plans import registry

    plan = plan_of(registry.queries()[name](spark, SF))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|PythonRDD", plan)


def test_no_row_per_token_is_shuffled_without_broadcasts(spark):
    p = prepared(spark, SF)
    p.split_adm, p.label_index, p.word_index, p.num_words
    with static_plans(spark):
        plan = plan_of(p.encoded())
    lines = plan.split("\n")
    by_word = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning(word#" in line and "ReusedExchange" not in line]
    # what is shuffled for the lookup has been gathered by document and word: no row for each place
    assert any("functions=[collect_list(pos#" in line for line in by_word) and not any("posexplode" in line for line in by_word), by_word


def test_split_and_batches_are_planned_once(spark):
    p = prepared(spark, SF)
    p.admission_splits, p.encoded_table
    with static_plans(spark):
        labelled, split, batches = plan_of(p.etl.labelled()), plan_of(p.etl.split(p.admission_splits)), plan_of(p.batched())
    assert len(shuffles(split)) == len(shuffles(labelled)) + 1, split
    lists = [line for line in batches.split("\n") if "FileScan parquet" in line and "word_ids" in line and "label_ids" in line]
    assert len(lists) == 1 and scans(batches) <= 4 and len(shuffles(batches)) <= 12, batches


def test_pooling_ships_a_vector_once_a_document(spark):
    from icdspark.operators import embeddings as em

    p = prepared(spark, SF)
    vectors = p.written_anew(ProxyTables(spark, SF).index_vectors(p.word_index.select("idx")), "vectors")
    with static_plans(spark):
        plan = plan_of(em.max_pool(p.encoded_table, vectors))
    assert "array_distinct" in plan and "Broadcast" not in plan
    with static_plans(spark):
        mean = plan_of(em.mean_vectors(p.split_adm, p.written_anew(p.word_index.join(vectors, "idx").select("word", "vector"), "by_word"), 64))
    assert "Broadcast" not in mean and "partial_count" in mean


def test_top_labels_make_no_row_for_each_pair(spark):
    from icdspark.operators import model as mo

    feats = spark.createDataFrame([(1, 1, [1.0, 2.0])], "subject_id long, hadm_id long, pooled array<double>")
    models = spark.createDataFrame([(j, [1.0, 0.5 * j], 0.0) for j in range(9)], "label long, weights array<double>, bias double")
    plan = plan_of(mo.top_k_scores(feats, models, 3))
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_admission_counts_read_each_input_once(spark):
    from icdspark.operators.cohort import admission_counts

    etl = proxy_etl(spark, SF)
    with static_plans(spark, broadcast=True):
        plan = plan_of(admission_counts(etl.notes(), etl.codes()))
    assert plan.count("documents.parquet") == 1 and "text:string" not in plan


def test_pooling_joins_no_vector_to_an_id(spark):
    from icdspark.operators import embeddings as em

    p = prepared(spark, SF)
    vectors = p.written_anew(ProxyTables(spark, SF).index_vectors(p.word_index.select("idx")), "vectors")
    with static_plans(spark):
        plans = [plan_of(f(p.encoded_table, vectors)) for f in (em.max_pool, em.sum_pool, em.token_vectors)]
    assert not any("Join" in plan for plan in plans)


def test_frequent_words_are_not_shuffled(spark):
    p = prepared(spark, SF)
    p.split_adm, p.label_index, p.word_index, p.num_words
    with static_plans(spark):
        plan = plan_of(p.encoded())
    by_word = below(plan, r"Exchange hashpartitioning\(word#")
    assert any("BroadcastHashJoin" in line and "LeftAnti" in line for line in by_word), plan


def test_split_reads_the_kept_codes(spark):
    p = prepared(spark, SF)
    p.admission_splits, p.kept_codes
    with static_plans(spark):
        plan = plan_of(p.etl.split(p.admission_splits, p.kept_codes))
        keys = plan_of(p.etl.admission_keys(p.kept_codes))
    assert p.admission_keys.exceptAll(p.etl.admission_keys()).count() == 0 == p.etl.admission_keys().exceptAll(p.admission_keys).count()
    assert "lineitem" not in plan + keys and p.kept_codes.count() == p.etl.cohort()[0].count()
    assert p.split_adm.select("hadm_id", "labels").exceptAll(p.etl.labelled().select("hadm_id", "labels")).count() == 0


def test_all_codes_are_filtered_before_their_orders_are_joined(spark):
    p = prepared(spark, SF)
    admissions = p.written_anew(p.etl.notes().select("hadm_id").distinct(), "note_admissions")
    with static_plans(spark, broadcast=True):
        plan = plan_of(p.etl.kept_codes(admissions))
    lines = [line for line in plan.split("\n") if "Join" in line]
    semi = [depth(line) for line in lines if "LeftSemi" in line]
    # with all codes, the only semi-joins are above the joins
    assert max(semi) > min(depth(line) for line in lines if "Inner" in line), plan


def test_kept_codes_without_a_narrower_source(spark):
    from icdspark.plans.etl import Etl

    notes = spark.createDataFrame([("1", "5", "10", "Discharge summary", "t")], "row_id string, subject_id string, hadm_id string, category string, text string")
    codes = spark.createDataFrame(
        [("5", "10", "1", "4019"), ("6", "20", "1", "4019"), ("7", "+10", "2", "25000")], "subject_id string, hadm_id string, seq_num string, icd9_code string")
    etl = Etl(notes, codes, codes.limit(0))
    kept = etl.kept_codes(etl.notes().select("hadm_id"))
    assert sorted(map(tuple, kept.select("subject_id", "hadm_id", "icd9_code").collect())) == sorted(
        map(tuple, etl.cohort()[0].select("subject_id", "hadm_id", "icd9_code").collect())) == [(5, 10, "401.9"), (7, 10, "250.00")]
    # ids that don't load are errors, in admissions without a note too
    for row, what in ((("8", "x", "1", "4019"), "bad hadm_id"), (("x", "20", "1", "4019"), "bad subject_id")):
        bad = codes.unionByName(spark.createDataFrame([row], codes.schema))
        with pytest.raises(Exception, match=what):
            Etl(notes, bad, codes.limit(0)).kept_codes(etl.notes().select("hadm_id")).collect()


def test_word2vec_tasks_follow_the_tokens(spark, monkeypatch):
    from icdspark.plans import prepare
    from icdspark.plans.prepare import Prepared

    p = Prepared.from_split_table(spark, prepared(spark, SF).split_adm)
    monkeypatch.setattr(prepare, "TRAIN_TOKENS", -(-p.num_tokens["train"] // 12))
    assert p.word2vec.getNumPartitions() == 12
    p.close()


def test_multi_hot_tasks_follow_the_characters(spark, monkeypatch):
    """A writer holds a page of up to a hundred rows, so a task gets few rows where they are long."""
    from pyspark.sql import functions as F

    from icdspark.plans import prepare
    from icdspark.plans.prepare import Prepared

    rows = [(d, d, "a b", f"l{d:03};l{(d + 1) % 200:03}" if d % 50 else "", "train", 2) for d in range(200)]
    table = spark.createDataFrame(rows, "subject_id long, hadm_id long, text string, labels string, split string, tlen int")
    p = Prepared.from_split_table(spark, table)
    monkeypatch.setattr(prepare, "ROW_CHARS", 200 * 10)
    out = p.multi_hot()
    labels = sorted({x for r in rows for x in r[3].split(";") if x})
    want = {r[1]: "".join("01"[x in r[3].split(";")] for x in labels) for r in rows if r[3]}
    assert {r["hadm_id"]: r["multi_hot"] for r in out.collect()} == want
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("part")).agg(F.count("multi_hot").alias("n")).collect()]
    assert len(sizes) >= 15 and max(sizes) <= 30
    p.close()
