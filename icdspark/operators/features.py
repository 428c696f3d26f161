"""Vocabulary, label index, document encoding, batching and code dictionaries.

Lookups (word -> id, label -> id) are equi-joins: the lookup tables are written
before they are used, so Spark knows their size, broadcasts a small one and
splits hot labels of a large one.  Only a bounded table, the most frequent words,
has a broadcast hint.  Id lists meet their vectors in ``shards``.
A document is known by (subject_id, hadm_id) throughout.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from icdspark.functions.arrays import MAX_DOC_TOKENS, pad_to, truncate
from icdspark.functions.codes import reformat_code
from icdspark.functions.text import split_on_space, split_whitespace
from icdspark.operators.cohort import LABEL_SEP
from icdspark.operators.running import grouped_row_number, range_bucket, row_number, word_bucket

# word2vec minimum count, batch sizes, padding id.
MIN_WORD_COUNT = 3
TRAIN_BATCH = 32
EVAL_BATCH = 32
TEST_BATCH = 1
PAD_ID = 0
#: Most frequent words that every task of an encoding gets.
HEAD_WORDS = 1 << 16
#: What identifies a document.
KEYS = ("subject_id", "hadm_id")


# ----------------------------------------------------------------- indexes


def distinct_labels(labelled: DataFrame) -> DataFrame:
    """h03: distinct non-empty labels over all splits."""
    labels = labelled.select(F.explode(F.split("labels", LABEL_SEP)).alias("label"))
    return labels.filter(F.col("label") != F.lit("")).distinct()


def label_index(labelled: DataFrame) -> DataFrame:
    """g03: dense 0-based ``idx`` over the sorted distinct labels (code-point order).

    Ranked with the bucketed row number, in ranges of labels with equal shares.
    """
    labels = distinct_labels(labelled)
    ranked = row_number(labels, ["label"], word_bucket("label"), name="__rn")
    return ranked.select("label", (F.col("__rn") - 1).alias("idx"))


def vocabulary(train: DataFrame, min_count: int = MIN_WORD_COUNT, text_col: str = "text") -> DataFrame:
    """i02: words of the training texts (split on one space, as fed to Word2Vec)
    occurring at least ``min_count`` times; '' is a word when texts have
    leading spaces.  A word count with map-side combining (hot words collapse
    before the shuffle)."""
    words = train.select(F.explode(split_on_space(text_col)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") >= min_count)


def word_index(vocab: DataFrame) -> DataFrame:
    """g04: 1-based ``idx`` by (count desc, word); 0 is padding, V+1 unknown.

    idx = (words with a higher count) + (rank of the word among words with its
    count).  The ranks are bucketed by ranges of whole words inside each count, with
    equal shares of the words whatever they begin with, so the large low-count
    groups are spread; the counts of words by count are a table far smaller than
    the vocabulary.
    """
    return grouped_row_number(vocab, -F.col("count"), ["word"], word_bucket("word"), "idx").select("word", "count", "idx")


# ------------------------------------------------------------- lookups


def doc_label_ids(docs: DataFrame, labels_index: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """d05: label ids per document; labels missing from the index are ignored.

    Returns ``keys, label_ids`` (sorted distinct ids); documents with no known
    label are absent (b08).
    """
    exploded = docs.select(*keys, F.explode(F.split("labels", LABEL_SEP)).alias("label"))
    joined = exploded.join(labels_index.select("label", "idx"), "label")
    return joined.groupBy(*keys).agg(F.array_sort(F.collect_set("idx")).alias("label_ids"))


def doc_word_ids(
    docs: DataFrame, words_index: DataFrame, num_words: int, keys: Sequence[str] = KEYS, max_len: int = MAX_DOC_TOKENS,
    partitions: int | None = None,
) -> DataFrame:
    """d06 + c11 + c13: word ids in text order, unknown words -> ``num_words + 1``.

    Truncation happens on the tokens before the lookup (one id per token, so
    it is the same as truncating ids) and bounds the per-document work.  The
    documents are shuffled once, by their keys, into ``partitions`` parts: a
    token's row is far larger than the token, so parts follow the number of
    tokens and not, as Spark would have it, the bytes shuffled.  The
    ``HEAD_WORDS`` most frequent words (nearly all tokens) are a small table that
    every task gets; their tokens are looked up where they are.  Each other
    distinct word of a document is looked up once, with the list of its places,
    so no row per token is shuffled and a hot word is one row a document.
    """
    tokens = truncate(split_whitespace("text"), max_len)
    docs = docs.select(*keys, F.array_join(tokens, " ").alias("tokens")).filter(F.col("tokens") != F.lit(""))
    docs = docs.repartition(partitions, *keys) if partitions else docs.repartition(*keys)
    toks = docs.select(*keys, F.posexplode(F.split("tokens", " ")).alias("pos", "word"))
    head = F.broadcast(words_index.filter(F.col("idx") <= F.lit(HEAD_WORDS)).select("word", F.col("idx").alias("id")))
    frequent = toks.join(head, "word").groupBy(*keys).agg(F.collect_list(F.struct("pos", "id")).alias("found")).select(
        *keys, F.col("found.pos").alias("places"), F.col("found.id").alias("ids"))
    terms = toks.join(head.select("word"), "word", "left_anti").groupBy(*keys, "word").agg(F.collect_list("pos").alias("places"))
    joined = terms.join(words_index.select("word", "idx"), "word", "left")
    rare = joined.select(*keys, "places", F.array(F.coalesce(F.col("idx"), F.lit(num_words + 1))).alias("ids"))
    # a row's places have one id each, or all the same one
    spread = F.transform("parts", lambda part: F.transform(part["places"], lambda p, i: F.struct(
        p.alias("pos"), F.get(part["ids"], F.when(F.size(part["ids"]) == 1, F.lit(0)).otherwise(i)).alias("id"))))
    return frequent.unionByName(rare).groupBy(*keys).agg(F.collect_list(F.struct("places", "ids")).alias("parts")).select(
        *keys, F.transform(F.array_sort(F.flatten(spread)), lambda s: s["id"]).alias("word_ids"))


def encode_documents(
    docs: DataFrame, labels_index: DataFrame, words_index: DataFrame, num_words: int,
    keys: Sequence[str] = KEYS, max_len: int = MAX_DOC_TOKENS, carry: Sequence[str] = (), partitions: int | None = None,
) -> DataFrame:
    """i05: ``keys, word_ids, label_ids`` (+ ``carry`` columns) for documents with a known label.

    A text is shuffled once (``doc_word_ids``, which ``partitions`` is for); what
    is regrouped and joined by ``keys`` behind the lookups are lists of numbers --
    not the exploded (doc, position, id) rows, which are several times larger.
    Labels stay sorted ids: a dense 0/1 vector (c15) is made where one is read.
    Documents with no word tokens keep an empty id list (the original keeps them
    too).
    """
    lab = doc_label_ids(docs, labels_index, keys)
    words = doc_word_ids(docs, words_index, num_words, keys, max_len, partitions)
    out = lab.join(words, list(keys), "left")
    if carry:
        out = out.join(docs.select(*keys, *carry), list(keys))
    return out.select(
        *keys, *carry, F.coalesce(F.col("word_ids"), F.array().cast("array<bigint>")).alias("word_ids"), "label_ids")


# ------------------------------------------------------- batching, padding


def batch_ids(
    df: DataFrame, batch_size: int, length_col: str, keys: Sequence[str] = KEYS, partition_cols: Sequence[str] = ()
) -> DataFrame:
    """g05: ``position`` (0-based, by length, then the last key first) and ``batch`` = position // batch_size."""
    ranked = grouped_row_number(
        df, F.col(length_col), list(reversed(keys)), range_bucket(keys[-1]), "__rn", partition_cols)
    return _batches(ranked, batch_size)


def shuffled_batch_ids(df: DataFrame, batch_size: int, seed: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """g11: ``position`` and ``batch`` along the seeded shuffle order."""
    return _batches(shuffled_positions(df, seed, keys), batch_size)


def _batches(ranked: DataFrame, batch_size: int) -> DataFrame:
    position = F.col("__rn") - 1
    return ranked.withColumn("position", position).withColumn(
        "batch", F.floor(position / F.lit(batch_size))).drop("__rn")


#: Rounds of the epoch shuffle, the prime of its round function, and the steps of a walk back into range.
SHUFFLE_ROUNDS, SHUFFLE_PRIME, SHUFFLE_WALK = 8, (1 << 31) - 1, 64


def round_keys(seed: int) -> list[tuple[int, int, int]]:
    """Three numbers below the prime for each round of the shuffle, drawn from ``seed``."""
    draw = random.Random(f"epoch:{seed}")
    return [tuple(draw.randrange(1, SHUFFLE_PRIME) for _ in range(3)) for _ in range(SHUFFLE_ROUNDS)]


def _mixed(half: Column, key: tuple[int, int, int]) -> Column:
    """The round function: two squarings modulo the prime; no product exceeds a bigint."""
    a, b, c = (F.lit(k).cast("bigint") for k in key)
    prime = F.lit(SHUFFLE_PRIME).cast("bigint")
    once = (half + a) % prime
    twice = (once * once % prime + b) % prime
    return twice * twice % prime * c % prime


def permuted(number: Column, rows: Column, seed: int) -> Column:
    """A keyed permutation of 0 .. rows - 1, an expression of the row's number alone.

    A Feistel network over pairs (left, right) of a grid that is just large
    enough: rounds add a function of one half to the other, modulo its size, so
    each can be undone.  A number that lands behind ``rows`` goes through again
    until it doesn't; fewer than a row of the grid lie there.
    """
    right = F.greatest(F.ceil(F.sqrt(rows.cast("double"))), F.lit(1))
    left = F.greatest(F.ceil(rows / right), F.lit(1))

    # a lambda's argument is worked out once; a plain expression would be spelt out twice in each round
    def bound(value: Column, use: Callable[[Column], Column]) -> Column:
        return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))

    def stir(pair: Column, k: int, key: tuple[int, int, int]) -> Column:
        l, r = pair["l"], pair["r"]
        if k % 2:
            return F.struct(((l + _mixed(r, key)) % left).alias("l"), r.alias("r"))
        return F.struct(l.alias("l"), ((r + _mixed(l, key)) % right).alias("r"))

    def once(x: Column) -> Column:
        pair = F.struct(F.floor(x / right).alias("l"), (x % right).alias("r"))
        for k, key in enumerate(round_keys(seed)):
            pair = bound(pair, partial(stir, k=k, key=key))
        return bound(pair, lambda p: p["l"] * right + p["r"])

    walk = F.sequence(F.lit(1), F.lit(SHUFFLE_WALK))
    return F.aggregate(walk, once(number), lambda x, _: F.when(x < rows, x).otherwise(once(x)))


def shuffled_positions(df: DataFrame, seed: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """g11: add ``__rn``, the row's 1-based place in the order of epoch ``seed``.

    The rows are numbered by their keys (which are distinct) and the numbers
    permuted, so an epoch's order depends on keys and seed alone, costs no sort
    of its own, and two epochs have nothing in common.
    """
    numbered = row_number(df, list(reversed(keys)), range_bucket(keys[-1]), "__number")
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return numbered.withColumn("__rows", rows).withColumn(
        "__rn", permuted(F.col("__number") - 1, F.col("__rows"), seed) + 1).drop("__number", "__rows")


def sort_within_batch(df: DataFrame, length_col: str = "length", partition_cols=()) -> DataFrame:
    """g06: ``slot`` inside each batch by (length desc, position desc); a batch is bounded."""
    w = Window.partitionBy(*partition_cols, "batch").orderBy(F.col(length_col).desc(), F.col("position").desc())
    return df.withColumn("slot", F.row_number().over(w) - 1)


def pad_batches(df: DataFrame, ids_col: str = "word_ids", partition_cols=()) -> DataFrame:
    """c14: pad ``ids_col`` with 0 to the longest document of its batch."""
    w = Window.partitionBy(*partition_cols, "batch")
    return df.withColumn("padded", pad_to(ids_col, F.max(F.size(ids_col)).over(w), PAD_ID))


def batch_and_pad(
    encoded: DataFrame, batch_size: int, length_col: str, keys: Sequence[str] = KEYS, partition_cols: Sequence[str] = ()
) -> DataFrame:
    """i06: g05 -> g06 -> c14 on encoded documents.

    Only keys and lengths are ranked and grouped into batches; the id lists
    are joined to them once and padded to the batch's longest list.
    """
    shape = encoded.select(*keys, *partition_cols, length_col, F.size("word_ids").alias("length"))
    batched = sort_within_batch(batch_ids(shape, batch_size, length_col, keys, partition_cols), "length", partition_cols)
    longest = Window.partitionBy(*partition_cols, "batch")
    batched = batched.withColumn("padded_len", F.max("length").over(longest)).drop(length_col, *partition_cols)
    return encoded.join(batched, list(keys)).withColumn("padded", pad_to("word_ids", F.col("padded_len"), PAD_ID))


# ------------------------------------------------------- code dictionaries


def merge_code_descriptions(diag: DataFrame, proc: DataFrame, text: DataFrame) -> DataFrame:
    """d09: precedence merge of the three description sources -> ``code, description``.

    Inputs carry ``pos`` (file order), ``code`` (raw) and ``description``.
    1. diagnosis entries, key = dotted diagnosis code, the last row wins;
    2. a procedure entry is skipped when its *raw* code is already a key,
       otherwise it overwrites key = dotted procedure code (last row wins);
    3. text entries (key = raw code) only fill absent keys; the first row wins.
    Step 2's "already a key" covers keys added by earlier procedure rows: only
    a raw code that is its own dotted form can hit one, and then only after the
    first not-skipped row with that key.  So among a key's free rows (raw code no
    diagnosis) the last one that isn't its own dotted form wins, or, if there is
    none, the first one.

    One join finds the free rows; the three sources then meet in one grouping by
    key.  A null key meets no other: each source's stands alone.
    """
    d = diag.select("pos", reformat_code("code", True).alias("key"), "description")
    p = proc.select("pos", F.col("code").alias("raw"), reformat_code("code", False).alias("key"), "description")
    taken = d.select(F.col("key").alias("raw")).distinct()
    own = F.col("raw") == F.col("key")
    free = p.join(taken, "raw", "left_anti").filter(F.col("key").isNotNull()).select(
        "pos", "key", "description", F.when(own, F.lit("own")).otherwise(F.lit("proc")).alias("src"))
    t = text.select("pos", F.col("code").alias("key"), "description")
    rows = d.withColumn("src", F.lit("diag")).unionByName(free).unionByName(t.withColumn("src", F.lit("text")))

    def row(src: str, pick: Callable[[Column], Column]) -> Column:
        return pick(F.when(F.col("src") == src, F.struct("pos", "description"))).alias(src)

    alone = F.when(F.col("key").isNull(), F.col("src")).alias("alone")
    found = rows.groupBy("key", alone).agg(row("proc", F.max), row("own", F.min), row("diag", F.max), row("text", F.min))
    best = F.coalesce("proc", "own", "diag", "text")
    return found.select(F.col("key").alias("code"), best["description"].alias("description"))


def describe_codes(codes: DataFrame, dictionary: DataFrame, code_col: str = "label") -> DataFrame:
    """d08: code -> description with '' for unknown codes (left join)."""
    dic = dictionary.select(F.col("code").alias(code_col), "description")
    return codes.join(dic, code_col, "left").withColumn("description", F.coalesce("description", F.lit("")))


def class_weights(frequency: DataFrame, labels_index: DataFrame, strict: bool = True) -> DataFrame:
    """d10 + e10 + g09: ``idx, label, weight = 1 - f / sum(f)`` in index order.

    A frequency label missing from the index raises (strict) like the original
    dictionary lookup; the check rides on the join itself (right side null).
    """
    joined = frequency.join(labels_index, "label", "left")
    if strict:
        joined = joined.withColumn(
            "idx", F.when(F.col("idx").isNull(), F.raise_error(F.concat(F.lit("unknown label "), F.col("label")))).otherwise(F.col("idx"))
        )
    total = frequency.agg(F.sum("frequency").cast("double").alias("__total"))  # one row
    out = joined.crossJoin(total).select(
        "idx", "label", (F.lit(1.0) - F.col("frequency") / F.col("__total")).cast("float").alias("weight")
    )
    return out.orderBy("idx")


def restrict_labels(labelled: DataFrame, keep: DataFrame) -> DataFrame:
    """b10: keep only labels in ``keep(label)``; drop admissions left with none.

    Label order inside an admission is preserved (position of the exploded label).
    """
    ex = labelled.select("subject_id", "hadm_id", F.posexplode(F.split("labels", LABEL_SEP)).alias("p", "label"))
    kept = ex.join(keep.select("label").distinct(), "label", "left_semi")
    grouped = kept.groupBy("subject_id", "hadm_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "label"))), lambda s: s["label"]), LABEL_SEP).alias("labels")
    )
    return labelled.drop("labels").join(grouped, ["subject_id", "hadm_id"])

