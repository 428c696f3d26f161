"""DuckDB (ANSI-ish SQL) forms of the proxy views and operators, for the oracle.

Regexes are the RE2 spellings of the cleaner rules (same matches on the test
data; RE2 has no look-ahead, so zero stripping is written with ``ltrim``).
"""

from __future__ import annotations

from icdspark.functions.text import CLEANER_RULES, PY_WHITESPACE

# Fixed value: the RE2 spelling of the cleaner's second rule; the others are the same in RE2.
_RE2_PUNCTUATION = r'[ "\[\]()*\-:;/{}@#$%^&+`~?><,!=._|]+'
RE2_CLEANER = tuple(
    (_RE2_PUNCTUATION if n == 1 else pattern, replacement) for n, (pattern, replacement) in enumerate(CLEANER_RULES)
)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean_sql(x: str) -> str:
    for pat, rep in RE2_CLEANER:
        x = f"regexp_replace({x}, {q(pat)}, {q(rep)}, 'g')"
    return x


def tokens_joined_sql(x: str) -> str:
    """Tokens of c05 re-joined by one space (c06)."""
    return f"regexp_replace(regexp_replace(lower({x}), {q(r'\s+$')}, ''), {q(r'\s')}, ' ', 'g')"


def split_ws_sql(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {q(PY_WHITESPACE)}), lambda x: x <> '')"


def pad_sql(c: str, n: int) -> str:
    c = f"CAST({c} AS VARCHAR)"
    return f"CASE WHEN length({c}) < {n} THEN lpad({c}, {n}, '0') ELSE {c} END"


def strip_zeros_sql(c: str) -> str:
    return f"(CASE WHEN {c} <> '' AND ltrim({c}, '0') = '' THEN '0' ELSE ltrim({c}, '0') END)"


def dot_diag_sql(c: str) -> str:
    return (
        f"(CASE WHEN starts_with({c}, 'E') THEN (CASE WHEN length({c}) > 4 THEN substr({c}, 1, 4) || '.' || substr({c}, 5) ELSE {c} END)"
        f" ELSE (CASE WHEN length({c}) > 3 THEN substr({c}, 1, 3) || '.' || substr({c}, 4) ELSE {c} END) END)"
    )


def dot_proc_sql(c: str) -> str:
    return f"(substr({c}, 1, 2) || '.' || substr({c}, 3))"


def loader_diag_sql(c: str) -> str:
    return dot_diag_sql(strip_zeros_sql(f"replace({c}, '\\s+', '')"))


def loader_proc_sql(c: str) -> str:
    return dot_proc_sql(strip_zeros_sql(f"replace({c}, '\\s+', '')"))


def reformat_sql(c: str, is_diag: bool) -> str:
    inner = f"replace({c}, '.', '')"
    return dot_diag_sql(inner) if is_diag else dot_proc_sql(inner)


# name -> (sql, dependencies).  Views are built only from the given base tables.
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "notes_raw": (
        """SELECT doc_id AS row_id, coalesce(o_custkey, doc_id - doc_id % 3) AS subject_id, doc_id - doc_id % 3 AS hadm_id,
       CASE WHEN lang = 'en' THEN 'Discharge summary' ELSE 'Nursing' END AS category, text
FROM documents LEFT JOIN orders ON o_orderkey = doc_id - doc_id % 3""",
        (),
    ),
    "diag_raw": (
        f"""SELECT o_custkey AS subject_id, l_orderkey AS hadm_id, l_linenumber AS seq_num,
       CASE l_suppkey % 10 WHEN 0 THEN 'E' || ({pad_sql('l_partkey', 4)})
                           WHEN 1 THEN 'V' || ({pad_sql('l_partkey', 4)})
                           ELSE {pad_sql('l_partkey', 5)} END AS icd9_code
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
        (),
    ),
    "proc_raw": (
        f"""SELECT o_custkey AS subject_id, l_orderkey AS hadm_id, l_linenumber AS seq_num,
       {pad_sql('l_suppkey', 4)} AS icd9_code
FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
        (),
    ),
    "diagnoses": (
        f"""SELECT subject_id, hadm_id, CAST(seq_num AS VARCHAR) AS seq_num, {loader_diag_sql('icd9_code')} AS icd9_code
FROM diag_raw WHERE subject_id IS NOT NULL AND hadm_id IS NOT NULL AND seq_num IS NOT NULL AND icd9_code IS NOT NULL""",
        ("diag_raw",),
    ),
    "procedures": (
        f"""SELECT subject_id, hadm_id, CAST(seq_num AS VARCHAR) AS seq_num, {loader_proc_sql('icd9_code')} AS icd9_code
FROM proc_raw WHERE subject_id IS NOT NULL AND hadm_id IS NOT NULL AND seq_num IS NOT NULL AND icd9_code IS NOT NULL""",
        ("proc_raw",),
    ),
    "notes": (
        """SELECT row_id, subject_id, hadm_id, text FROM notes_raw WHERE category = 'Discharge summary'""",
        ("notes_raw",),
    ),
    "codes": (
        """SELECT subject_id, hadm_id, seq_num, icd9_code, 0 AS src FROM diagnoses
UNION ALL SELECT subject_id, hadm_id, seq_num, icd9_code, 1 AS src FROM procedures""",
        ("diagnoses", "procedures"),
    ),
    "tok_notes": (
        f"SELECT row_id, subject_id, hadm_id, {tokens_joined_sql(clean_sql('text'))} AS text FROM notes",
        ("notes",),
    ),
    "kept_codes": (
        "SELECT * FROM codes WHERE hadm_id IN (SELECT hadm_id FROM tok_notes)",
        ("codes", "tok_notes"),
    ),
    "kept_notes": (
        "SELECT * FROM tok_notes WHERE hadm_id IN (SELECT hadm_id FROM kept_codes)",
        ("kept_codes", "tok_notes"),
    ),
    "adm_texts": (
        "SELECT subject_id, hadm_id, string_agg(text, ' ' ORDER BY row_id) AS text FROM kept_notes GROUP BY subject_id, hadm_id",
        ("kept_notes",),
    ),
    "adm_labels": (
        """SELECT subject_id, hadm_id,
       string_agg(icd9_code, ';' ORDER BY src, TRY_CAST(seq_num AS BIGINT), seq_num, icd9_code) AS labels
FROM kept_codes GROUP BY subject_id, hadm_id""",
        ("kept_codes",),
    ),
    "labelled": (
        """SELECT t.subject_id, t.hadm_id, t.text, l.labels FROM adm_texts t
JOIN adm_labels l ON t.subject_id = l.subject_id AND t.hadm_id = l.hadm_id""",
        ("adm_texts", "adm_labels"),
    ),
}


def with_ctes(body: str, *names: str, extra: dict[str, tuple[str, tuple[str, ...]]] | None = None) -> str:
    """Prefix ``body`` with the CTEs it needs (transitively, dependencies first)."""
    table = dict(CTES)
    table.update(extra or {})
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in table[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    parts = [f"{n} AS (\n{table[n][0]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body


# Prediction proxy (dense long table) and helpers used by metric oracles.
CTES["pred"] = (
    """SELECT vec_id AS instance, CAST(j AS BIGINT) AS label, 8.0 * CAST(x AS DOUBLE) AS logit,
       1.0 / (1.0 + exp(-(8.0 * CAST(x AS DOUBLE)))) AS score,
       CASE WHEN label = j OR (vec_id + label) % n = j THEN 1 ELSE 0 END AS y
FROM (SELECT vec_id, label, len(embedding) AS n, unnest(embedding) AS x, unnest(range(len(embedding))) AS j FROM embeddings)""",
    (),
)


def tied(sql: str) -> str:
    """The same query over predictions with logits rounded down to half units (``pred_tied`` of the proxies)."""
    return sql.replace("8.0 * CAST(x AS DOUBLE)", "floor(8.0 * CAST(x AS DOUBLE) / 0.5) * 0.5")


CTES["predh"] = ("SELECT *, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS yhat FROM pred", ("pred",))
CTES["per_label"] = (
    """SELECT label, CAST(sum(y * yhat) AS DOUBLE) AS i, CAST(sum(greatest(y, yhat)) AS DOUBLE) AS u,
       CAST(sum(yhat) AS DOUBLE) AS h, CAST(sum(y) AS DOUBLE) AS t FROM predh GROUP BY label""",
    ("predh",),
)
CTES["per_instance"] = (
    """SELECT instance, CAST(sum(y * yhat) AS DOUBLE) AS i, CAST(sum(greatest(y, yhat)) AS DOUBLE) AS u,
       CAST(sum(yhat) AS DOUBLE) AS h, CAST(sum(y) AS DOUBLE) AS t FROM predh GROUP BY instance""",
    ("predh",),
)
CTES["score_counts"] = (
    "SELECT label, score, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg FROM pred GROUP BY label, score",
    ("pred",),
)
CTES["score_cum"] = (
    """SELECT label, score, pos, neg,
       coalesce(sum(pos) OVER (PARTITION BY label ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_below,
       coalesce(sum(neg) OVER (PARTITION BY label ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
       sum(pos) OVER (PARTITION BY label) AS p, sum(neg) OVER (PARTITION BY label) AS n
FROM score_counts""",
    ("score_counts",),
)
CTES["micro_counts"] = (
    "SELECT score, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg FROM pred GROUP BY score",
    ("pred",),
)
CTES["micro_cum"] = (
    """SELECT score, pos, neg,
       coalesce(sum(pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_below,
       coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
       sum(pos) OVER () AS p, sum(neg) OVER () AS n
FROM micro_counts""",
    ("micro_counts",),
)
CTES["label_auc"] = (
    """SELECT label, sum(pos * (neg_below + neg / 2.0)) / (CAST(max(p) AS DOUBLE) * max(n)) AS auc
FROM score_cum GROUP BY label HAVING max(p) > 0 AND max(n) > 0""",
    ("score_cum",),
)


def r9(expr: str) -> str:
    return f"round({expr}, 9)"
