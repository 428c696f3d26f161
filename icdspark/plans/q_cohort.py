"""Registered queries: ingest, text/code expressions, cohort, labelled admissions."""

from __future__ import annotations

from pyspark.sql import functions as F

from icdspark.functions import codes as fc
from icdspark.functions import text as ft
from icdspark.functions.dates import iso_to_date
from icdspark.operators import cohort as co
from icdspark.plans.etl import Etl, proxy_etl
from icdspark.plans.prepare import prepared
from icdspark.plans.registry import register
from icdspark.plans.sql import (
    clean_sql,
    loader_diag_sql,
    loader_proc_sql,
    reformat_sql,
    split_ws_sql,
    tokens_joined_sql,
    with_ctes,
)
from icdspark.sources.proxy import ProxyTables

# --------------------------------------------------------------------- a: loads


@register(
    "a04_load_diagnoses",
    with_ctes("SELECT subject_id, hadm_id, seq_num, icd9_code FROM diagnoses", "diagnoses"),
)
def a04(spark, sf):
    return proxy_etl(spark, sf).diagnoses()


@register(
    "a05_load_procedures",
    with_ctes("SELECT subject_id, hadm_id, seq_num, icd9_code FROM procedures", "procedures"),
)
def a05(spark, sf):
    return proxy_etl(spark, sf).procedures()


@register("a06_load_notes", with_ctes("SELECT row_id, subject_id, hadm_id, text FROM notes", "notes"))
def a06(spark, sf):
    return proxy_etl(spark, sf).notes()


# -------------------------------------------------------- b: projections/filters


@register(
    "b01_projection",
    with_ctes("SELECT subject_id, hadm_id, category FROM notes_raw", "notes_raw"),
)
def b01(spark, sf):
    return ProxyTables(spark, sf).notes_raw().select("subject_id", "hadm_id", "category")


@register(
    "b02_drop_null_rows",
    "SELECT doc_id, quality, toxic FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL",
)
def b02(spark, sf):
    return ProxyTables(spark, sf).table("labels").select("doc_id", "quality", "toxic").na.drop(how="any")


@register(
    "b03_category_filter",
    with_ctes("SELECT row_id, hadm_id FROM notes_raw WHERE category = 'Discharge summary'", "notes_raw"),
)
def b03(spark, sf):
    raw = ProxyTables(spark, sf).notes_raw()
    return raw.filter(F.col("category") == co.DISCHARGE_CATEGORY).select("row_id", "hadm_id")


@register(
    "b04_strict_cast",
    with_ctes(
        "SELECT CAST(CAST(subject_id AS VARCHAR) AS BIGINT) AS subject_id, "
        "CAST(CAST(hadm_id AS VARCHAR) AS BIGINT) AS hadm_id FROM diag_raw",
        "diag_raw",
    ),
)
def b04(spark, sf):
    bronze = ProxyTables.bronze(ProxyTables(spark, sf).diag_raw())
    return bronze.select(co._id("subject_id", "raise").alias("subject_id"), co._id("hadm_id", "raise").alias("hadm_id"))


_DAMAGED = {
    "damaged": (
        """SELECT CASE WHEN seq_num <> 6 THEN CAST(subject_id AS VARCHAR) END AS subject_id,
       CASE WHEN seq_num = 7 THEN 'A' ELSE '' END || CAST(hadm_id AS VARCHAR) AS hadm_id, CAST(seq_num AS VARCHAR) AS seq_num, icd9_code
FROM diag_raw""",
        ("diag_raw",),
    ),
}


def _quarantined(spark, sf):
    px, p = ProxyTables(spark, sf), prepared(spark, sf)
    etl = Etl(px.bronze(px.notes_raw()), px.diag_damaged(), px.bronze(px.proc_raw()))
    return etl.quarantined(p.written_anew)


@register(
    "b04_quarantine_kept",
    with_ctes(
        f"SELECT CAST(subject_id AS BIGINT) AS subject_id, CAST(hadm_id AS BIGINT) AS hadm_id, seq_num, {loader_diag_sql('icd9_code')} AS icd9_code "
        "FROM damaged WHERE subject_id IS NOT NULL AND TRY_CAST(hadm_id AS BIGINT) IS NOT NULL",
        "damaged", extra=_DAMAGED,
    ),
)
def b04_kept(spark, sf):
    """What loads of a table with ids that don't."""
    return _quarantined(spark, sf)[0].diagnoses()


@register(
    "b04_quarantine_rejects",
    with_ctes(
        "SELECT CASE WHEN subject_id IS NULL THEN 'subject_id' ELSE 'hadm_id' END AS \"column\", "
        "CASE WHEN subject_id IS NULL THEN 'null' ELSE 'not an integer' END AS reason, subject_id, hadm_id, seq_num, icd9_code "
        "FROM damaged WHERE subject_id IS NULL OR TRY_CAST(hadm_id AS BIGINT) IS NULL",
        "damaged", extra=_DAMAGED,
    ),
)
def b04_rejects(spark, sf):
    """The rejected rows, their source columns taken out of the VARIANT again."""
    rejects = _quarantined(spark, sf)[1]["diag_raw"]
    fields = [F.variant_get("source", f"$.{c}", "string").alias(c) for c in ("subject_id", "hadm_id", "seq_num", "icd9_code")]
    return rejects.select("column", "reason", *fields)


@register(
    "b05_drop_columns",
    with_ctes("SELECT row_id, subject_id, hadm_id FROM notes_raw", "notes_raw"),
)
def b05(spark, sf):
    return ProxyTables(spark, sf).notes_raw().drop("category", "text")


@register(
    "b06_positional_rename",
    "SELECT o_orderkey AS hadm_id, o_custkey AS subject_id FROM orders",
)
def b06(spark, sf):
    return ProxyTables(spark, sf).table("orders").select("o_orderkey", "o_custkey").toDF("hadm_id", "subject_id")


# ------------------------------------------------------ c: text and code exprs


@register(
    "c01_clean_text",
    with_ctes(f"SELECT row_id, {clean_sql('text')} AS clean FROM notes_raw", "notes_raw"),
)
def c01(spark, sf):
    return ProxyTables(spark, sf).notes_raw().select("row_id", ft.clean_note("text").alias("clean"))


@register(
    "c02_icd_diag",
    with_ctes(f"SELECT DISTINCT icd9_code AS raw, {loader_diag_sql('icd9_code')} AS code FROM diag_raw", "diag_raw"),
)
def c02(spark, sf):
    raw = ProxyTables(spark, sf).diag_raw()
    return raw.select(F.col("icd9_code").alias("raw")).distinct().select("raw", fc.dot_diagnosis("raw").alias("code"))


@register(
    "c03_icd_proc",
    with_ctes(f"SELECT DISTINCT icd9_code AS raw, {loader_proc_sql('icd9_code')} AS code FROM proc_raw", "proc_raw"),
)
def c03(spark, sf):
    raw = ProxyTables(spark, sf).proc_raw()
    return raw.select(F.col("icd9_code").alias("raw")).distinct().select("raw", fc.dot_procedure("raw").alias("code"))


@register(
    "c04_reformat_code",
    with_ctes(
        f"SELECT DISTINCT icd9_code AS raw, {reformat_sql('icd9_code', True)} AS diag_code, "
        f"{reformat_sql('icd9_code', False)} AS proc_code FROM diag_raw",
        "diag_raw",
    ),
)
def c04(spark, sf):
    raw = ProxyTables(spark, sf).diag_raw().select(F.col("icd9_code").alias("raw")).distinct()
    return raw.select(
        "raw", fc.reformat_code("raw", True).alias("diag_code"), fc.reformat_code("raw", False).alias("proc_code")
    )


@register(
    "c05_tokenize",
    with_ctes(
        f"SELECT row_id, {tokens_joined_sql(clean_sql('text'))} AS tokens, "
        f"CASE WHEN {clean_sql('text')} = '' THEN 1 "
        f"WHEN regexp_replace(lower({clean_sql('text')}), '\\s+$', '') = '' THEN 0 "
        f"ELSE len(regexp_split_to_array(regexp_replace(lower({clean_sql('text')}), '\\s+$', ''), '\\s')) END AS n_tokens "
        "FROM notes_raw",
        "notes_raw",
    ),
)
def c05(spark, sf):
    toks = ft.tokenize(ft.clean_note("text"))
    return ProxyTables(spark, sf).notes_raw().select(
        "row_id", F.array_join(toks, " ").alias("tokens"), F.size(toks).cast("bigint").alias("n_tokens")
    )


@register(
    "c06_join_tokens",
    with_ctes(f"SELECT row_id, subject_id, hadm_id, text FROM tok_notes", "tok_notes"),
)
def c06(spark, sf):
    return proxy_etl(spark, sf).tokenized_notes()


@register(
    "c08_token_count",
    with_ctes(
        f"SELECT row_id, CASE WHEN text = '' THEN 1 WHEN regexp_replace(lower(text), '\\s+$', '') = '' THEN 0 "
        f"ELSE len(regexp_split_to_array(regexp_replace(lower(text), '\\s+$', ''), '\\s')) END AS n_tokens FROM notes_raw",
        "notes_raw",
    ),
)
def c08(spark, sf):
    return ProxyTables(spark, sf).notes_raw().select(
        "row_id", ft.token_count(ft.tokenize("text")).cast("bigint").alias("n_tokens")
    )


@register(
    "c09_text_length",
    with_ctes("SELECT hadm_id, len(string_split(text, ' ')) AS length FROM labelled", "labelled"),
)
def c09(spark, sf):
    return proxy_etl(spark, sf).labelled().select("hadm_id", ft.text_length("text").cast("bigint").alias("length"))


@register(
    "c10_split_space",
    with_ctes(
        "SELECT hadm_id, list_count(string_split(text, ' ')) AS n_pieces, "
        "len(list_filter(string_split(text, ' '), lambda x: x = '')) AS n_empty FROM labelled",
        "labelled",
    ),
)
def c10(spark, sf):
    pieces = ft.split_on_space("text")
    return proxy_etl(spark, sf).labelled().select(
        "hadm_id",
        F.size(pieces).cast("bigint").alias("n_pieces"),
        F.size(F.filter(pieces, lambda x: x == F.lit(""))).cast("bigint").alias("n_empty"),
    )


@register(
    "c11_split_whitespace",
    with_ctes(
        f"SELECT row_id, len({split_ws_sql('text')}) AS n_words, array_to_string({split_ws_sql('text')}, '|') AS words "
        "FROM notes_raw",
        "notes_raw",
    ),
)
def c11(spark, sf):
    words = ft.split_whitespace("text")
    return ProxyTables(spark, sf).notes_raw().select(
        "row_id", F.size(words).cast("bigint").alias("n_words"), F.array_join(words, "|").alias("words")
    )


@register(
    "c12_split_labels",
    with_ctes(
        "SELECT hadm_id, unnest(string_split(labels, ';')) AS label FROM labelled",
        "labelled",
    ),
)
def c12(spark, sf):
    return co.explode_labels(proxy_etl(spark, sf).labelled(), keep_empty=True).select("hadm_id", "label")


@register(
    "c19_iso_date",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders",
)
def c19(spark, sf):
    o = ProxyTables(spark, sf).table("orders").select("o_orderkey", "o_orderdate")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return o.select("o_orderkey", iso_to_date(iso).alias("d"))


# ------------------------------------------------------ h, d, e: cohort, groups


@register(
    "h01_union_codes",
    with_ctes("SELECT subject_id, hadm_id, seq_num, icd9_code, src FROM codes", "codes"),
)
def h01(spark, sf):
    return proxy_etl(spark, sf).codes()


@register(
    "h02_distinct_admissions",
    with_ctes("SELECT DISTINCT hadm_id FROM codes", "codes"),
)
def h02(spark, sf):
    return proxy_etl(spark, sf).codes().select("hadm_id").distinct()


@register(
    "d01_semi_codes",
    with_ctes("SELECT subject_id, hadm_id, seq_num, icd9_code, src FROM kept_codes", "kept_codes"),
)
def d01(spark, sf):
    return proxy_etl(spark, sf).cohort()[0]


@register(
    "d02_semi_notes",
    with_ctes("SELECT row_id, subject_id, hadm_id, text FROM kept_notes", "kept_notes"),
)
def d02(spark, sf):
    return proxy_etl(spark, sf).cohort()[1]


@register(
    "e04_concat_labels",
    with_ctes("SELECT subject_id, hadm_id, labels FROM adm_labels", "adm_labels"),
)
def e04(spark, sf):
    return co.admission_labels(proxy_etl(spark, sf).cohort()[0])


@register(
    "e05_concat_texts",
    with_ctes("SELECT subject_id, hadm_id, text FROM adm_texts", "adm_texts"),
)
def e05(spark, sf):
    return co.admission_texts(proxy_etl(spark, sf).cohort()[1])


@register(
    "d03_labelled_admissions",
    with_ctes("SELECT subject_id, hadm_id, text, labels FROM labelled", "labelled"),
)
def d03(spark, sf):
    return proxy_etl(spark, sf).labelled()


@register(
    "d03_strict_labelled_admissions",
    with_ctes("SELECT subject_id, hadm_id, text, labels FROM labelled", "labelled"),
)
def d03_strict(spark, sf):
    p = prepared(spark, sf)
    return p.etl.strict_labelled(lambda df: p.written_anew(df, "strict_labelled"))


@register(
    "e01_input_counts",
    with_ctes(
        "SELECT (SELECT count(*) FROM notes) AS n_notes, (SELECT count(*) FROM procedures) AS n_procedures, "
        "(SELECT count(*) FROM diagnoses) AS n_diagnoses",
        "notes",
        "procedures",
        "diagnoses",
    ),
)
def e01(spark, sf):
    e = proxy_etl(spark, sf)
    return co.input_counts(e.notes(), e.procedures(), e.diagnoses())


@register(
    "e02_distinct_codes",
    with_ctes("SELECT count(DISTINCT icd9_code) AS n_codes FROM codes", "codes"),
)
def e02(spark, sf):
    return co.distinct_codes(proxy_etl(spark, sf).codes())


@register(
    "e03_admission_counts",
    with_ctes(
        "SELECT (SELECT count(DISTINCT hadm_id) FROM tok_notes) AS notes_admissions, "
        "(SELECT count(DISTINCT hadm_id) FROM codes) AS codes_admissions, "
        "(SELECT count(DISTINCT hadm_id) FROM kept_notes) AS kept_notes_admissions, "
        "(SELECT count(DISTINCT hadm_id) FROM kept_codes) AS kept_codes_admissions",
        "kept_notes",
        "kept_codes",
    ),
)
def e03(spark, sf):
    e = proxy_etl(spark, sf)
    return co.admission_counts(e.notes(), e.codes())


@register(
    "e06_admissions_per_patient",
    with_ctes("SELECT subject_id, count(*) AS n_admissions FROM labelled GROUP BY subject_id", "labelled"),
)
def e06(spark, sf):
    return co.admissions_per_patient(proxy_etl(spark, sf).labelled())


@register(
    "e07_label_frequency",
    with_ctes(
        "SELECT icd9_code AS label, count(DISTINCT hadm_id) AS frequency FROM kept_codes GROUP BY icd9_code",
        "kept_codes",
    ),
)
def e07(spark, sf):
    return prepared(spark, sf).label_frequency


@register(
    "g08_top50_codes",
    with_ctes(
        "SELECT icd9_code AS label, count(DISTINCT hadm_id) AS frequency FROM kept_codes GROUP BY icd9_code "
        "ORDER BY frequency DESC, label LIMIT 50",
        "kept_codes",
    ),
)
def g08(spark, sf):
    return co.top_labels(prepared(spark, sf).label_frequency, 50)


@register(
    "b07_drop_empty_labels",
    with_ctes(
        "SELECT hadm_id, label FROM (SELECT hadm_id, unnest(string_split(labels, ';')) AS label FROM labelled) WHERE label <> ''",
        "labelled",
    ),
)
def b07(spark, sf):
    return co.explode_labels(proxy_etl(spark, sf).labelled()).select("hadm_id", "label")
