"""Registered queries: label/word indexes, encoding, batching, dictionaries, weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from icdspark.functions.arrays import l2_normalize, truncate
from icdspark.functions.text import split_whitespace
from icdspark.operators import cohort as co
from icdspark.operators import features as fe
from icdspark.plans.etl import proxy_etl
from icdspark.plans.prepare import prepared
from icdspark.plans.q_split import _SPLIT_CTES
from icdspark.plans.registry import register
from icdspark.plans.sql import r9, reformat_sql, split_ws_sql, with_ctes
from icdspark.sources.files import parse_text_dictionary
from icdspark.sources.proxy import ProxyTables

# ------------------------------------------------------------------ SQL views

_FEAT_CTES = dict(_SPLIT_CTES)
_FEAT_CTES.update(
    {
        "label_idx": (
            """SELECT label, row_number() OVER (ORDER BY label) - 1 AS idx FROM (
  SELECT DISTINCT label FROM (SELECT unnest(string_split(labels, ';')) AS label FROM labelled) WHERE label <> '')""",
            ("labelled",),
        ),
        "vocab": (
            """SELECT word, count(*) AS count FROM (
  SELECT unnest(string_split(text, ' ')) AS word FROM split_adm WHERE split = 'train') GROUP BY word HAVING count(*) >= 3""",
            ("split_adm",),
        ),
        "word_idx": (
            "SELECT word, count, row_number() OVER (ORDER BY count DESC, word) AS idx FROM vocab",
            ("vocab",),
        ),
        "doc_tokens": (
            f"""SELECT subject_id, hadm_id, unnest(toks) AS word, unnest(range(len(toks))) AS pos FROM (
  SELECT subject_id, hadm_id, list_slice({split_ws_sql('text')}, 1, 2500) AS toks FROM labelled)""",
            ("labelled",),
        ),
        "doc_words": (
            """SELECT t.subject_id, t.hadm_id,
       string_agg(CAST(coalesce(w.idx, (SELECT count(*) FROM word_idx) + 1) AS VARCHAR), ' ' ORDER BY t.pos) AS word_ids,
       count(*) AS n_ids
FROM doc_tokens t LEFT JOIN word_idx w ON t.word = w.word GROUP BY t.subject_id, t.hadm_id""",
            ("doc_tokens", "word_idx"),
        ),
        "doc_labels": (
            """SELECT subject_id, hadm_id, list_sort(list(DISTINCT idx)) AS label_ids FROM (
  SELECT l.subject_id, l.hadm_id, i.idx FROM (SELECT subject_id, hadm_id, unnest(string_split(labels, ';')) AS label FROM labelled) l
  JOIN label_idx i ON l.label = i.label) GROUP BY subject_id, hadm_id""",
            ("labelled", "label_idx"),
        ),
        "top50": (
            """SELECT icd9_code AS label FROM kept_codes GROUP BY icd9_code
ORDER BY count(DISTINCT hadm_id) DESC, label LIMIT 50""",
            ("kept_codes",),
        ),
        "diag_desc": ("SELECT p_partkey AS pos, CAST(p_partkey // 2 AS VARCHAR) AS code, p_name AS description FROM part", ()),
        "proc_desc": ("SELECT p_partkey AS pos, CAST(p_partkey // 3 AS VARCHAR) AS code, p_type AS description FROM part", ()),
    }
)


def fsql(body: str, *names: str) -> str:
    return with_ctes(body, *names, extra=_FEAT_CTES)


# ------------------------------------------------------------- spark helpers


def _ids_str(c):
    return F.array_join(F.col(c).cast("array<string>"), " ")


# ------------------------------------------------------------------ indexes


@register("h03_distinct_labels", fsql(
    "SELECT DISTINCT label FROM (SELECT unnest(string_split(labels, ';')) AS label FROM labelled) WHERE label <> ''",
    "labelled"))
def h03(spark, sf):
    return fe.distinct_labels(proxy_etl(spark, sf).labelled())


@register("g03_label_index", fsql("SELECT label, idx FROM label_idx", "label_idx"))
def g03(spark, sf):
    return prepared(spark, sf).label_index


@register("i02_vocabulary", fsql("SELECT word, count FROM vocab", "vocab"))
def i02(spark, sf):
    return fe.vocabulary(prepared(spark, sf).train)


@register("g04_word_index", fsql("SELECT word, count, idx FROM word_idx", "word_idx"))
def g04(spark, sf):
    return prepared(spark, sf).word_index


# ------------------------------------------------------------------ lookups


@register("d05_label_ids", fsql(
    "SELECT subject_id, hadm_id, array_to_string(label_ids, ' ') AS label_ids FROM doc_labels", "doc_labels"))
def d05(spark, sf):
    p = prepared(spark, sf)
    return fe.doc_label_ids(p.labelled, p.label_index).select(*fe.KEYS, _ids_str("label_ids").alias("label_ids"))


@register("d06_word_ids", fsql("SELECT subject_id, hadm_id, word_ids, n_ids FROM doc_words", "doc_words"))
def d06(spark, sf):
    p = prepared(spark, sf)
    out = fe.doc_word_ids(p.labelled, p.word_index, p.num_words, partitions=p.text_parts)
    return out.select(*fe.KEYS, _ids_str("word_ids").alias("word_ids"), F.size("word_ids").cast("bigint").alias("n_ids"))


@register("c13_truncate", fsql(
    f"""SELECT hadm_id, len({split_ws_sql('text')}) AS n_tokens, len(list_slice({split_ws_sql('text')}, 1, 2500)) AS n_kept
FROM labelled""", "labelled"))
def c13(spark, sf):
    lab = proxy_etl(spark, sf).labelled()
    toks = split_whitespace("text")
    return lab.select("hadm_id", F.size(toks).cast("bigint").alias("n_tokens"), F.size(truncate(toks)).cast("bigint").alias("n_kept"))


@register("c15_multi_hot", fsql(
    """SELECT subject_id, hadm_id, array_to_string(list_transform(range((SELECT count(*) FROM label_idx)),
       lambda i: CASE WHEN list_contains(label_ids, i) THEN 1 ELSE 0 END), '') AS multi_hot FROM doc_labels""",
    "doc_labels", "label_idx"))
def c15(spark, sf):
    return prepared(spark, sf).multi_hot()


_ENCODED_SQL = fsql(
    """SELECT w.subject_id, w.hadm_id, a.split, w.word_ids, array_to_string(l.label_ids, ' ') AS label_ids
FROM doc_words w JOIN doc_labels l USING (subject_id, hadm_id) JOIN split_adm a USING (subject_id, hadm_id)""",
    "doc_words", "doc_labels", "split_adm")


def _encoded_rows(enc):
    return enc.select(*fe.KEYS, "split", _ids_str("word_ids").alias("word_ids"), _ids_str("label_ids").alias("label_ids"))


@register("i05_encode_documents", _ENCODED_SQL)
def i05(spark, sf):
    return _encoded_rows(prepared(spark, sf).encoded())


@register("b10_restrict_top50", fsql(
    """SELECT subject_id, hadm_id, string_agg(label, ';' ORDER BY p) AS labels FROM (
  SELECT subject_id, hadm_id, unnest(string_split(labels, ';')) AS label, unnest(range(len(string_split(labels, ';')))) AS p
  FROM labelled) WHERE label IN (SELECT label FROM top50) GROUP BY subject_id, hadm_id""", "labelled", "top50"))
def b10(spark, sf):
    p = prepared(spark, sf)
    top = co.top_labels(p.label_frequency, 50)
    return fe.restrict_labels(p.labelled, top).select("subject_id", "hadm_id", "labels")


@register("b08_drop_unlabelled_docs", fsql(
    """SELECT subject_id, hadm_id, array_to_string(list_sort(list(DISTINCT idx)), ' ') AS label_ids FROM (
  SELECT l.subject_id, l.hadm_id, t.idx FROM (SELECT subject_id, hadm_id, unnest(string_split(labels, ';')) AS label FROM labelled) l
  JOIN (SELECT label, row_number() OVER (ORDER BY label) - 1 AS idx FROM top50) t ON l.label = t.label) GROUP BY subject_id, hadm_id""",
    "labelled", "top50"))
def b08(spark, sf):
    p = prepared(spark, sf)
    top = co.top_labels(p.label_frequency, 50).select(F.col("label").alias("labels"))
    out = fe.doc_label_ids(p.labelled, fe.label_index(top))
    return out.select(*fe.KEYS, _ids_str("label_ids").alias("label_ids"))


# ---------------------------------------------------------- batching, padding


@register("g05_batches", fsql(
    """SELECT split, subject_id, hadm_id, position, position // 32 AS batch FROM (
  SELECT split, subject_id, hadm_id,
         row_number() OVER (PARTITION BY split ORDER BY len(string_split(text, ' ')), hadm_id, subject_id) - 1 AS position
  FROM split_adm)""", "split_adm"))
def g05(spark, sf):
    rows = prepared(spark, sf).split_adm.select("split", *fe.KEYS, "tlen")
    out = fe.batch_ids(rows, fe.EVAL_BATCH, "tlen", partition_cols=["split"])
    return out.select("split", *fe.KEYS, F.col("position").cast("bigint").alias("position"), F.col("batch").cast("bigint").alias("batch"))


_BATCHED_CTE = {
    "enc": (
        """SELECT a.split, a.subject_id, a.hadm_id, len(string_split(a.text, ' ')) AS tlen,
       coalesce(w.word_ids, '') AS word_ids, coalesce(w.n_ids, 0) AS n_ids
FROM split_adm a JOIN doc_labels l USING (subject_id, hadm_id) LEFT JOIN doc_words w USING (subject_id, hadm_id)""",
        ("split_adm", "doc_words", "doc_labels"),
    ),
    "batched": (
        """SELECT *, position // 32 AS batch FROM (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY tlen, hadm_id, subject_id) - 1 AS position FROM enc)""",
        ("enc",),
    ),
}


def bsql(body: str, *names: str) -> str:
    extra = dict(_FEAT_CTES)
    extra.update(_BATCHED_CTE)
    return with_ctes(body, *names, extra=extra)


def _batched(spark, sf):
    return prepared(spark, sf).batched(fe.EVAL_BATCH)


@register("g06_sort_in_batch", bsql(
    """SELECT split, subject_id, hadm_id, batch,
       row_number() OVER (PARTITION BY split, batch ORDER BY n_ids DESC, position DESC) - 1 AS slot
FROM batched""", "batched"))
def g06(spark, sf):
    out = _batched(spark, sf)
    return out.select("split", *fe.KEYS, F.col("batch").cast("bigint").alias("batch"), F.col("slot").cast("bigint").alias("slot"))


@register("i06_batch_pad", bsql(
    """SELECT split, subject_id, hadm_id, batch, max(n_ids) OVER (PARTITION BY split, batch) AS padded_len,
       max(n_ids) OVER (PARTITION BY split, batch) - n_ids AS n_pad FROM batched""", "batched"))
def i06(spark, sf):
    out = _batched(spark, sf)
    return out.select(
        "split", *fe.KEYS, F.col("batch").cast("bigint").alias("batch"),
        F.size("padded").cast("bigint").alias("padded_len"),
        (F.size("padded") - F.size("word_ids")).cast("bigint").alias("n_pad"),
    )


@register("c14_pad", bsql(
    """SELECT split, subject_id, hadm_id,
       ltrim(word_ids || repeat(' 0', (max(n_ids) OVER (PARTITION BY split, batch) - n_ids)::INTEGER)) AS padded
FROM batched""", "batched"))
def c14(spark, sf):
    return _batched(spark, sf).select("split", *fe.KEYS, _ids_str("padded").alias("padded"))


def _shuffle_sql(seed: int) -> str:
    """The permutation the other way round: every position is taken back, round by round, to the row that stands there."""
    p = fe.SHUFFLE_PRIME
    steps = [f"""undo{fe.SHUFFLE_ROUNDS} AS (
  SELECT x AS position, x // b AS l, x % b AS r FROM grid, range(a * b) AS t(x))"""]
    for k, (u, v, w) in reversed(list(enumerate(fe.round_keys(seed)))):
        f = lambda h: f"((((({h} + {u}) % {p}) * (({h} + {u}) % {p}) % {p} + {v}) % {p}) * (((({h} + {u}) % {p}) * (({h} + {u}) % {p}) % {p} + {v}) % {p}) % {p}) * {w} % {p}"
        l, r = (f"(((l - {f('r')}) % a) + a) % a", "r") if k % 2 else ("l", f"(((r - {f('l')}) % b) + b) % b")
        steps.append(f"undo{k} AS (SELECT position, {l} AS l, {r} AS r FROM undo{k + 1}, grid)")
    return fsql(f"""SELECT subject_id, hadm_id, position, position // 32 AS batch FROM (
  WITH RECURSIVE rows_ AS (
    SELECT subject_id, hadm_id, row_number() OVER (ORDER BY hadm_id, subject_id) - 1 AS number FROM split_adm WHERE split = 'train'),
  grid AS (
    SELECT n, b, greatest(ceil(n / b), 1)::BIGINT AS a FROM (
      SELECT n, greatest(ceil(sqrt(n)), 1)::BIGINT AS b FROM (SELECT count(*) AS n FROM rows_))),
  {(","+chr(10)+"  ").join(steps)},
  back AS (SELECT undo0.position, l * b + r AS x FROM undo0, grid),
  walk AS (
    SELECT position, x FROM back, grid WHERE position < n
    UNION ALL SELECT w.position, back.x FROM walk w, back, grid WHERE w.x >= grid.n AND back.position = w.x)
  SELECT subject_id, hadm_id, position FROM walk JOIN rows_ ON x = number)""", "split_adm")


def _shuffled(spark, sf, seed: int):
    out = fe.shuffled_batch_ids(prepared(spark, sf).train.select(*fe.KEYS), fe.TRAIN_BATCH, seed)
    return out.select(*fe.KEYS, F.col("position").cast("bigint").alias("position"), F.col("batch").cast("bigint").alias("batch"))


@register("g11_epoch_shuffle", _shuffle_sql(1))
def g11(spark, sf):
    return _shuffled(spark, sf, 1)


@register("g11_epoch_shuffle_next", _shuffle_sql(2))
def g11_next(spark, sf):
    """The order of another epoch."""
    return _shuffled(spark, sf, 2)


# ------------------------------------------------------- dictionaries, weights


def _dictionary(spark, sf):
    px = ProxyTables(spark, sf)
    text = parse_text_dictionary(px.text_dictionary_lines())
    return fe.merge_code_descriptions(px.diag_dictionary(), px.proc_dictionary(), text)


_DICT_SQL = {
    "d_entries": (
        f"""SELECT key, arg_max(description, pos) AS description FROM (
  SELECT pos, {reformat_sql('code', True)} AS key, description FROM diag_desc) GROUP BY key""",
        ("diag_desc",),
    ),
    "p_rows": (
        f"""SELECT pos, code AS raw, {reformat_sql('code', False)} AS key, description,
       code IN (SELECT key FROM d_entries) AS in_d FROM proc_desc""",
        ("proc_desc", "d_entries"),
    ),
    "p_entries": (
        """SELECT key, arg_max(description, pos) AS description FROM p_rows r
WHERE NOT in_d AND NOT (raw = key AND (key IN (SELECT key FROM d_entries)
      OR pos > (SELECT min(pos) FROM p_rows r2 WHERE r2.key = r.key AND NOT r2.in_d)))
GROUP BY key""",
        ("p_rows", "d_entries"),
    ),
    "dp": (
        "SELECT key, description FROM d_entries WHERE key NOT IN (SELECT key FROM p_entries) UNION ALL SELECT key, description FROM p_entries",
        ("d_entries", "p_entries"),
    ),
    "t_rows": (
        """SELECT pos, toks[1] AS key, array_to_string(toks[2:], ' ') AS description FROM (
  SELECT p_partkey AS pos, list_filter(regexp_split_to_array('  ' || code || '   ' || p_brand || '  ' || p_type, '\\s+'), lambda x: x <> '') AS toks
  FROM (SELECT p_partkey, p_brand, p_type, CAST(p_partkey * 2 // 3 AS VARCHAR) AS raw FROM part) s,
  LATERAL (SELECT """ + reformat_sql('raw', True) + """ AS code) c)""",
        (),
    ),
    "merged": (
        """SELECT key AS code, description FROM dp UNION ALL
SELECT key AS code, arg_min(description, pos) AS description FROM t_rows WHERE key NOT IN (SELECT key FROM dp) GROUP BY key""",
        ("dp", "t_rows"),
    ),
}


def dsql(body: str, *names: str) -> str:
    extra = dict(_FEAT_CTES)
    extra.update(_DICT_SQL)
    return with_ctes(body, *names, extra=extra)


@register("d09_merge_descriptions", dsql("SELECT code, description FROM merged", "merged"))
def d09(spark, sf):
    return _dictionary(spark, sf)


@register("a14_text_dictionary", dsql("SELECT pos, key AS code, description FROM t_rows", "t_rows"))
def a14(spark, sf):
    return parse_text_dictionary(ProxyTables(spark, sf).text_dictionary_lines()).select("pos", "code", "description")


@register("d08_describe_labels", dsql(
    """SELECT l.label, coalesce(m.description, '') AS description FROM label_idx l LEFT JOIN merged m ON l.label = m.code""",
    "label_idx", "merged"))
def d08(spark, sf):
    return fe.describe_codes(prepared(spark, sf).label_index.select("label"), _dictionary(spark, sf))


_DICT_SQL["freq"] = (
    "SELECT icd9_code AS label, count(DISTINCT hadm_id) AS frequency FROM kept_codes GROUP BY icd9_code",
    ("kept_codes",),
)


@register("e10_class_weights", dsql(
    """SELECT i.idx, f.label, CAST(1.0 - f.frequency / (SELECT CAST(sum(frequency) AS DOUBLE) FROM freq) AS FLOAT) AS weight
FROM freq f JOIN label_idx i ON f.label = i.label""", "label_idx", "freq"))
def e10(spark, sf):
    p = prepared(spark, sf)
    return fe.class_weights(p.label_frequency, p.label_index)


# ---------------------------------------------------------- vectors, pooling


@register("c18_l2_normalize", fsql(
    f"""SELECT vec_id AS idx, d AS dim, {r9('CAST(embedding[d + 1] AS DOUBLE) / (sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) + 1e-6)')} AS value
FROM embeddings, range(len(embedding)) AS r(d)"""))
def c18(spark, sf):
    v = ProxyTables(spark, sf).vectors().select("idx", l2_normalize("vector").alias("v"))
    return v.select("idx", F.posexplode("v").alias("dim", "value")).select(
        "idx", F.col("dim").cast("bigint").alias("dim"), F.round("value", 9).alias("value"))


@register("d10_frequency_class_index", dsql(
    "SELECT f.label, f.frequency, i.idx FROM freq f JOIN label_idx i ON f.label = i.label", "label_idx", "freq"))
def d10(spark, sf):
    p = prepared(spark, sf)
    freq = p.label_frequency
    w = fe.class_weights(freq, p.label_index)
    return freq.join(w.select("label", "idx"), "label").select("label", "frequency", "idx")


@register("g09_weights_by_index", dsql(
    """SELECT idx, CAST(1.0 - f.frequency / (SELECT CAST(sum(frequency) AS DOUBLE) FROM freq) AS FLOAT) AS weight,
       row_number() OVER (ORDER BY idx) AS ord FROM freq f JOIN label_idx i ON f.label = i.label""", "label_idx", "freq"))
def g09(spark, sf):
    """Weights in class-index order; ``ord`` makes the order observable (idx is dense)."""
    p = prepared(spark, sf)
    w = fe.class_weights(p.label_frequency, p.label_index)
    return w.select("idx", "weight", (F.col("idx") + 1).alias("ord"))


@register("g10_preview_rows", fsql(
    "SELECT subject_id, hadm_id, text, labels FROM labelled ORDER BY hadm_id, subject_id LIMIT 20", "labelled"))
def g10(spark, sf):
    """Preview: the first 20 labelled admissions by key (the limit is the feature; a bounded top-k)."""
    return proxy_etl(spark, sf).labelled().orderBy("hadm_id", "subject_id").limit(20)


@register("h04_fpr_grid", fsql(
    """SELECT DISTINCT fpr FROM (
  SELECT round(CAST(n - neg_below AS DOUBLE) / n, 9) AS fpr FROM score_cum UNION ALL SELECT 0.0)""", "score_cum"))
def h04(spark, sf):
    from icdspark.operators import roc

    return roc.fpr_grid(ProxyTables(spark, sf).pred()).select(F.round("fpr", 9).alias("fpr")).distinct()
