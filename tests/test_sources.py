"""CSV/Parquet sources and sinks (a01-a03, a07-a15)."""

import os

from pyspark.sql import functions as F

from icdspark.sources import files as fs


def test_infer_view_name():
    assert fs.infer_view_name("data/DIAGNOSES_ICD.csv") == "DIAGNOSES_ICD"
    assert fs.infer_view_name("/x/y/notes_labeled") == "notes_labeled"
    assert fs.infer_view_name("???") == "???"


def test_csv_multiline_quoted(spark, tmp_dir):
    path = os.path.join(tmp_dir, "NOTEEVENTS.csv")
    with open(path, "w") as f:
        f.write('ROW_ID,SUBJECT_ID,TEXT\n1,10,"line one\nline ""two"", end"\n2,11,plain\n')
    df = fs.read_csv_table(spark, path)
    rows = df.orderBy("ROW_ID").collect()
    assert rows[0]["TEXT"] == 'line one\nline "two", end'
    assert rows[1]["TEXT"] == "plain"
    assert dict(df.dtypes)["ROW_ID"] == "string"
    assert spark.table("NOTEEVENTS").count() == 2


def test_csv_sink_and_word_vectors_roundtrip(spark, tmp_dir):
    vecs = spark.createDataFrame([("a", [0.5, -1.25]), ("b", [1.0, 2.0])], "word string, vector array<double>")
    path = os.path.join(tmp_dir, "word_embeddings.csv")
    fs.write_word_vectors(vecs, path, single_file=True)
    assert len([p for p in os.listdir(path) if p.endswith(".csv")]) == 1
    back = {r["word"]: r["vector"] for r in fs.read_word_vectors(spark, path).collect()}
    assert back == {"a": [0.5, -1.25], "b": [1.0, 2.0]}


def test_label_lists_crlf(spark, tmp_dir):
    p1 = os.path.join(tmp_dir, "codes.csv")
    p2 = os.path.join(tmp_dir, "freq.csv")
    with open(p1, "wb") as f:
        f.write(b"401.9\r\n250.00\r\n")
    with open(p2, "wb") as f:
        f.write(b"401.9,20053\r\n250.00,7\r\n")
    assert [r[0] for r in fs.read_label_list(spark, p1).collect()] == ["401.9", "250.00"]
    rows = fs.read_label_list(spark, p2, with_frequency=True).collect()
    assert [(r[0], r[1]) for r in rows] == [("401.9", 20053), ("250.00", 7)]


def test_code_and_text_dictionaries(spark, tmp_dir):
    p = os.path.join(tmp_dir, "D_ICD_DIAGNOSES.csv")
    with open(p, "w") as f:
        f.write('ROW_ID,ICD9_CODE,SHORT_TITLE,LONG_TITLE\n1,4019,Hypertension NOS,"Unspecified, essential hypertension"\n')
    row = fs.read_code_dictionary(spark, p).first()
    assert (row["code"], row["description"]) == ("4019", "Unspecified, essential hypertension")
    t = os.path.join(tmp_dir, "ICD9_descriptions")
    with open(t, "w") as f:
        f.write("401.9\tUnspecified   essential hypertension\n@\tdummy\n")
    rows = fs.read_text_dictionary(spark, t).collect()
    assert [(r["code"], r["description"]) for r in rows] == [("401.9", "Unspecified essential hypertension"), ("@", "dummy")]


def test_descriptions_from_files(spark, tmp_dir):
    """The readers' rows go straight into the merge."""
    from icdspark.operators.features import merge_code_descriptions

    def write(name, text):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)
        return os.path.join(tmp_dir, name)

    diag = write("D_ICD_DIAGNOSES.csv", 'ROW_ID,ICD9_CODE,LONG\n1,4019,"old, name"\n2,4019,"new\nname"\n')
    proc = write("D_ICD_PROCEDURES.csv", "ROW_ID,ICD9_CODE,LONG\n1,3893,line\n")
    text = write("ICD9_descriptions", "999  first  one\n\n999 second\n38.93 other\n")
    merged = merge_code_descriptions(
        fs.read_code_dictionary(spark, diag), fs.read_code_dictionary(spark, proc), fs.read_text_dictionary(spark, text))
    assert {r["code"]: r["description"] for r in merged.collect()} == {
        "401.9": "new\nname", "38.93": "line", "999": "first one"}


def test_partitioned_parquet_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([(1, "train"), (2, "val"), (3, "test")], "hadm_id long, split string")
    out = os.path.join(tmp_dir, "encoded")
    fs.write_table(df, out, partition_by=["split"])
    back = spark.read.parquet(out).filter(F.col("split") == "val")
    assert [r["hadm_id"] for r in back.collect()] == [2]


def test_read_splits_csv_and_parquet(spark, tmp_dir):
    for split, rows in (("train", "1,10,a b,401.9"), ("val", "2,20,c,38.93;401.9")):
        d = os.path.join(tmp_dir, "csv")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, f"{split}_split.csv"), "w") as f:
            f.write("SUBJECT_ID,HADM_ID,TEXT,LABELS\n" + rows + "\n")
    df = fs.read_splits(spark, os.path.join(tmp_dir, "csv"), fmt="csv")
    got = {(r["hadm_id"], r["split"], r["labels"]) for r in df.collect()}
    assert got == {(10, "train", "401.9"), (20, "val", "38.93;401.9")}
    out = os.path.join(tmp_dir, "pq")
    fs.write_table(df, out, partition_by=["split"])
    assert fs.read_splits(spark, out).filter("split = 'val'").count() == 1


def test_join_vector(spark):
    from icdspark.functions.text import join_vector

    df = spark.createDataFrame([([0.5, -2.0],), (None,)], "v array<double>")
    assert [r[0] for r in df.select(join_vector("v")).collect()] == ["0.5 -2.0", None]


def test_strict_id_cast_raises_and_quarantine_drops(spark):
    import pytest

    from icdspark.operators.cohort import load_notes

    raw = spark.createDataFrame(
        [("1", "10", "100", "Discharge summary", "t"), ("2", "x1", "100", "Discharge summary", "t")],
        "row_id string, subject_id string, hadm_id string, category string, text string",
    )
    with pytest.raises(Exception, match="bad subject_id"):
        load_notes(raw).collect()
    assert [r["row_id"] for r in load_notes(raw, on_bad="quarantine").collect()] == [1]


def test_scale_conf():
    from icdspark.session import scale_conf

    conf = scale_conf(100 * (1 << 40), cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert scale_conf(1 << 20, cores=8)["spark.sql.shuffle.partitions"] == "16"


def test_csv_files_to_encoded_splits(spark, tmp_dir):
    """The whole path a user takes: three CSV files, split CSVs, word vectors, encoded Parquet."""
    from icdspark.operators import embeddings as em
    from icdspark.plans.etl import csv_etl
    from icdspark.plans.prepare import Prepared

    def write(name, header, rows):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(header + "\n" + "\n".join(rows) + "\n")

    notes, codes = [], []
    for i in range(40):
        notes.append(f'{i},{100 + i},{200 + i},2101-01-01,,,Discharge summary,Report,,,"Patient, stable today\n""home"" w{i % 3} w{i % 3}"')
        notes.append(f"{100 + i},{100 + i},{200 + i},2101-01-01,,,Nursing,Report,,,other")
        codes.append(f"{i},{100 + i},{200 + i},1,{4019 if i % 2 else 25000}")
    write("NOTEEVENTS.csv", "ROW_ID,SUBJECT_ID,HADM_ID,CHARTDATE,CHARTTIME,STORETIME,CATEGORY,DESCRIPTION,CGID,ISERROR,TEXT", notes)
    write("DIAGNOSES_ICD.csv", "ROW_ID,SUBJECT_ID,HADM_ID,SEQ_NUM,ICD9_CODE", codes)
    write("PROCEDURES_ICD.csv", "ROW_ID,SUBJECT_ID,HADM_ID,SEQ_NUM,ICD9_CODE", ["1,100,200,1,3893"])

    p = Prepared(spark, csv_etl(spark, tmp_dir), folder=os.path.join(tmp_dir, "stages"))
    rows = {r["hadm_id"]: r for r in p.split_adm.collect()}
    assert len(rows) == 40 and rows[200]["labels"] == "250.00;38.93" and rows[201]["labels"] == "401.9"
    assert rows[201]["text"] == "patient stable today home w1 w1"
    assert {r["split"] for r in rows.values()} == {"train", "val", "test"}

    fs.write_splits(p.split_adm, os.path.join(tmp_dir, "splits"))
    back = fs.read_splits(spark, os.path.join(tmp_dir, "splits"), fmt="csv")
    assert {(r["hadm_id"], r["split"], r["text"]) for r in back.collect()} == {
        (r["hadm_id"], r["split"], r["text"]) for r in rows.values()}

    fs.write_word_vectors(em.word_vectors(p.word2vec), os.path.join(tmp_dir, "word_embeddings.csv"))
    vectors = fs.read_word_vectors(spark, os.path.join(tmp_dir, "word_embeddings.csv"))
    assert {r["word"] for r in vectors.collect()} == {r["word"] for r in p.word_index.collect()}

    out = os.path.join(tmp_dir, "encoded")
    fs.write_table(p.encoded(), out, partition_by=["split"])
    enc = {r["hadm_id"]: r for r in spark.read.parquet(out).collect()}
    index = {r["word"]: r["idx"] for r in p.word_index.collect()}
    assert enc[201]["word_ids"] == [index[w] for w in rows[201]["text"].split()]
    p.close()
    assert os.path.exists(os.path.join(tmp_dir, "stages"))  # the caller's own folder stays


def test_shared_folder_is_an_error_off_local_masters():
    import pytest

    from icdspark.session import checkpoint_dir

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_own_stage_tables_are_deleted(spark):
    from icdspark.plans.etl import proxy_etl
    from icdspark.plans.prepare import Prepared

    p = Prepared(spark, proxy_etl(spark, "/root/testdata/sf0.001"))
    p.label_index
    assert os.path.exists(p.folder)
    p.close()
    assert not os.path.exists(p.folder)


CODE_SCHEMA = "subject_id string, hadm_id string, seq_num string, icd9_code string"


def test_rejected_rows_are_kept_apart(spark, tmp_dir):
    from icdspark.operators.cohort import split_rejects

    rows = [("1", "10", "1", "4019"), (None, "x", "2", "4019"), ("1", "1x", "3", "4019"), ("2", "20", None, "4019"), ("3", "30", "1", "")]
    raw = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], CODE_SCHEMA + ", extra int")
    written = []

    def write(df):
        df.write.parquet(os.path.join(tmp_dir, "checked"))
        written.append(1)
        return spark.read.parquet(os.path.join(tmp_dir, "checked"))

    for store in (None, write):
        kept, bad = split_rejects(raw, ("subject_id", "hadm_id"), raw.columns, store)
        assert [tuple(r) for r in kept.orderBy("extra").collect()] == [(*rows[0], 0), (*rows[4], 4)]
        got = bad.select("column", "reason", F.variant_get("source", "$.extra", "int").alias("i")).orderBy("i").collect()
        assert [tuple(r) for r in got] == [("subject_id", "null", 1), ("hadm_id", "not an integer", 2), ("seq_num", "null", 3)]
        assert kept.count() + bad.count() == raw.count()
    assert written == [1]


def test_quarantined_etl_loads_the_rest(spark):
    from icdspark.plans.etl import Etl

    notes = spark.createDataFrame(
        [("1", "5", "10", "Discharge summary", "a"), ("2", "5", "ten", "Discharge summary", "b"), ("x", "y", "z", "Nursing", "c")],
        "row_id string, subject_id string, hadm_id string, category string, text string")
    diag = spark.createDataFrame([("5", "10", "1", "4019"), ("5", "?", "2", "4019")], CODE_SCHEMA)
    etl, rejects = Etl(notes, diag, diag.limit(0)).quarantined()
    assert [(r["hadm_id"], r["labels"]) for r in etl.labelled().collect()] == [(10, "401.9")]
    assert {k: v.count() for k, v in rejects.items()} == {"notes_raw": 1, "diag_raw": 1, "proc_raw": 0}


def test_strict_join_raises_on_a_missing_partner(spark, tmp_dir):
    import pytest

    from icdspark.operators.cohort import MissingKeys, observed_join, strict_labelled_admissions

    def write(name):
        def stored(df):
            df.write.parquet(os.path.join(tmp_dir, name))
            return spark.read.parquet(os.path.join(tmp_dir, name))
        return stored

    codes = spark.createDataFrame([(1, 10, "1", "401.9", 0), (2, 20, "1", "250.00", 0)], "subject_id long, hadm_id long, seq_num string, icd9_code string, src int")
    notes = spark.createDataFrame([(1, 1, 10, "a"), (2, 2, 20, "b")], "row_id long, subject_id long, hadm_id long, text string")
    assert strict_labelled_admissions(codes, notes, write("whole")).count() == 2
    # another patient's note on the second admission: in the cohort, but without a partner
    other = spark.createDataFrame([(1, 1, 10, "a"), (2, 3, 20, "b"), (3, 4, 20, "c")], notes.schema)
    with pytest.raises(MissingKeys) as found:
        strict_labelled_admissions(codes, other, write("broken"))
    assert found.value.counts == {"without_labels": 2, "without_text": 1}
    joined, counts = observed_join(
        other.select("subject_id", "hadm_id", "text"), codes.select("subject_id", "hadm_id", F.col("icd9_code").alias("labels")))
    assert joined.count() == 1 and counts.get == {"without_labels": 2, "without_text": 1}


def test_admission_counts_from_bitmaps(spark):
    from icdspark.operators.cohort import admission_counts

    ids = [0, 1, -1, -40_000, 32_768, 32_769, 1 << 40, (1 << 63) - 1, None, 1, 1]
    notes = spark.createDataFrame([(i,) for i in ids], "hadm_id long")
    codes = spark.createDataFrame([(i,) for i in [1, 32_769, 5, None, -1, 5]], "hadm_id long")
    assert tuple(admission_counts(notes, codes).first()) == (8, 4, 3, 3)
    assert tuple(admission_counts(notes.limit(0), codes).first()) == (0, 4, 0, 0)


def test_dictionary_files_follow_each_other_by_name(spark, tmp_dir):
    """The last row wins across files too, whatever their sizes."""
    from icdspark.operators.features import merge_code_descriptions

    folder = os.path.join(tmp_dir, "D_ICD_DIAGNOSES")
    os.makedirs(folder)
    for name, rows in (("a.csv", 1), ("b.csv", 300), ("c.csv", 2)):
        with open(os.path.join(folder, name), "w") as f:
            f.write("ROW_ID,ICD9_CODE,LONG\n" + "".join(f"{k},4019,{name} {k}\n" for k in range(rows)))
    empty = spark.createDataFrame([], "pos struct<file:string,row:long>, code string, description string")
    merged = merge_code_descriptions(fs.read_code_dictionary(spark, folder), empty, empty)
    assert [tuple(r) for r in merged.collect()] == [("401.9", "c.csv 1")]


def test_session_settings_stay_as_they_are(spark):
    from icdspark.plans import registry

    before = dict(spark.sparkContext.getConf().getAll()), {k: spark.conf.get(k, None) for k in ("spark.checkpoint.dir", "spark.sql.shuffle.partitions")}
    registry.queries()["d03_labelled_admissions"](spark, "/root/testdata/sf0.001").count()
    after = dict(spark.sparkContext.getConf().getAll()), {k: spark.conf.get(k, None) for k in ("spark.checkpoint.dir", "spark.sql.shuffle.partitions")}
    assert before == after


def test_entry_works_without_the_extra_queries_dependencies():
    """A missing dependency of the optional subpackage costs its queries, not the others."""
    import subprocess
    import sys

    code = (
        "import sys\n"
        "class Blocked:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.split('.')[0] in ('ahocorasick', 'xxhash'):\n"
        "            raise ImportError(name)\n"
        "sys.meta_path.insert(0, Blocked())\n"
        "import __spark_entry__ as e\n"
        "names = set(e.queries())\n"
        "from icdspark.plans import registry\n"
        "assert names == set(registry.queries()) == set(e.oracle_sql()), names\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
