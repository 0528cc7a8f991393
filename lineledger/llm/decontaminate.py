"""Benchmark decontamination by winnowing, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineledger.llm.shared import Staged
from lineledger.operators import blocks_for, bloom_bytes, bloom_filter, maybe_in

FILTER_BYTES = 64 * 1024**2  # of a filter that is sent to every executor: some fifty million texts
WINDOW = 13  # words that have to agree
GRAM = 8  # words of a fingerprint
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased: runs of digits, a-z and everything beyond ASCII; none for null."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.coalesce(F.array_remove(F.split(lowered, _BETWEEN), ""), F.expr("CAST(array() AS array<string>)"))


def _places(first: int | str, last: str) -> str:
    """Positions from ``first`` to ``last``, none if that is before it."""
    return f"IF({last} >= {first}, sequence({first}, {last}), CAST(array() AS array<int>))"


def _once(rows: DataFrame, **columns: str) -> DataFrame:
    """``rows`` with further columns that are worked out once per row.

    A plain projection may be merged into the next one, and an expression that a loop there refers to would be
    worked out again for each of the loop's elements. Generators are not merged.
    """
    fields = ", ".join(f"'{name}', {expression}" for name, expression in columns.items())
    return rows.selectExpr("*", f"inline(array(named_struct({fields})))")


def _gram(n: int | str, of: str = "words", at: str = "i") -> str:
    return f"xxhash64({n}, slice({of}, {at}, {n}))"


def fingerprints(rows: DataFrame, short: list[int], window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``rows`` with ``words``, and in ``prints`` the different fingerprints of each.

    Of the hashes of ``gram`` words in each run of ``window`` words the least is kept, so any two texts with
    ``window`` words in common have a fingerprint in common there. Runs of each length in ``short`` are all kept,
    for items that are no longer than that.
    """
    width = window - gram + 1
    hashed = f"transform({_places(1, f'size(words) - {gram - 1}')}, i -> {_gram(gram)})"
    prints = f"array_distinct(transform({_places(1, f'size(words) - {window - 1}')}, i -> array_min(slice(grams, i, {width}))))"
    for n in short:
        prints = f"concat({prints}, array_distinct(transform({_places(1, f'size(words) - {n - 1}')}, i -> {_gram(n)})))"
    rows = _once(rows, grams=hashed, n_words="size(words)")
    return _once(rows, prints=prints).drop("grams")


def _shifts() -> str:
    """How far apart a document's and an item's words are wherever they have one of ``prints`` in common."""

    def places(of: str) -> str:
        all_ = f"transform({_places(1, f'size({of}) - n + 1')}, i -> named_struct('at', i, 'print', {_gram('n', of)}))"
        return f"filter({all_}, x -> array_contains(prints, x.print))"

    same = f"filter({places('item_words')}, y -> y.print = x.print)"
    return f"array_distinct(flatten(transform({places('words')}, x -> transform({same}, y -> x.at - y.at))))"


def _agreeing() -> tuple[str, str]:
    """Expressions over a document's ``words`` and an item's ``item_words`` that lie ``shift`` places further on.

    ``agree`` has a 1 for each place of the item whose word is the document's, and ``hits`` are the places in the
    document that windows of agreeing words cover.
    """
    same = "IF(element_at(words, i + shift) <=> element_at(item_words, i), '1', '0')"
    first = "greatest(1, 1 - shift)"
    places = _places(first, "least(size(item_words), size(words) - shift)")
    agree = f"array_join(transform({places}, i -> {same}), '')"
    covered = "exists(sequence(greatest(1, i - span + 1), i), a -> substring(agree, a, span) = repeat('1', span))"
    hits = f"transform(filter({_places(1, 'length(agree)')}, i -> {covered}), i -> i + {first} - 1 + shift)"
    return agree, hits


def _with_pairs(rows: DataFrame, pairs: DataFrame, staged: Staged) -> DataFrame:
    """``rows`` without most of those that have no pair; the filter drops them where they are read.

    Beyond :data:`FILTER_BYTES` there is no filter, and the join that follows drops them after its shuffle.
    """
    marks = pairs.select("met_mark").distinct()
    count = marks.count()
    if bloom_bytes(count) > FILTER_BYTES:
        return rows
    blocks = blocks_for(count)
    return maybe_in(rows, "mark", staged(bloom_filter(marks, blocks), "filter"), blocks)


def _of_same_row(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
    same = rows["id"].eqNullSafe(found["met_id"]) & (rows["mark"] == found["met_mark"])
    return rows.join(found, same, how).drop("met_id", "met_mark")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    least_share: int = 20,
    mark_col: str | None = None,
) -> DataFrame:
    """``(id, n_words, n_hit, n_items, items, contaminated)`` for each row of ``docs``.

    A window is ``window`` words in a row of an item, or a shorter item as a whole. A document's word is hit if an
    occurrence of a window covers it; a document is contaminated if at least one of ``least_share`` words is.
    ``items`` are the ids of the items with windows in the document, as sorted strings.

    Fingerprints of documents and items are joined. Where a document and an item have one in common, its places in
    both give how far their words are apart, and along each such shift the words are compared, so hits are exact. Null
    texts and texts without words have no hits and are in no item. Items with the same id are one item in the
    result; an item without an id is listed as an empty string. Rows that share an id are told apart by their text.
    ``mark_col`` names a further column with the XXH64 of the text, null as empty, by which they can be found again.
    """
    staged = Staged(docs.sparkSession, "contamination")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text.alias("text")).withColumn("mark", F.xxhash64("text"))
    item_id = F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item")
    items = benchmark.select(item_id, words(F.col(item_text_col).cast("string")).alias("words")).where("size(words) > 0")
    items = staged(items.distinct().withColumn("item_mark", F.xxhash64("words")), "items")
    # at most window - 1 small numbers
    short = [r.n for r in items.selectExpr("size(words) AS n").where(f"n < {window}").distinct().orderBy("n").collect()]
    long_items = fingerprints(items.where(f"size(words) >= {window}"), [], window, gram)
    known = long_items.selectExpr("item", "item_mark", f"{gram} AS n", "explode(prints) AS print")
    for n in short:
        whole = f"xxhash64({n}, words) AS print"
        known = known.unionByName(items.where(f"size(words) = {n}").selectExpr("item", "item_mark", f"{n} AS n", whole))
    known = staged(known, "prints")

    # one pass over the texts; a row for each document tells its number of words, whatever it has in common
    worded = _once(rows.withColumn("split", words(F.col("text"))).drop("text"), words="split").drop("split")
    printed = fingerprints(worded, short, window, gram)
    own = "named_struct('print', mark, 'n_words', n_words)"
    shown = "transform(prints, p -> named_struct('print', p, 'n_words', CAST(NULL AS INT)))"
    printed = printed.selectExpr("id", "mark", f"inline(concat(array({own}), {shown}))")
    met = printed.join(known, "print", "left").where("item IS NOT NULL OR n_words IS NOT NULL")
    met = staged(met.distinct(), "met")
    sized = met.where("n_words IS NOT NULL").selectExpr("id AS met_id", "mark AS met_mark", "n_words").distinct()

    pairs = met.where("item IS NOT NULL AND n_words IS NULL").groupBy("id", "mark", "item", "item_mark", "n")
    pairs = pairs.agg(F.collect_set("print").alias("prints")).withColumnsRenamed({"id": "met_id", "mark": "met_mark"})
    pairs = pairs.join(items.withColumnRenamed("words", "item_words"), ["item", "item_mark"])
    pairs = staged(pairs, "pairs")
    # always by shuffle: the texts that have pairs grow with the input, and so does this join's share of the work
    near = _with_pairs(rows, pairs, staged)
    both = _of_same_row(near, pairs.hint("merge"), "inner").withColumn("split", words(F.col("text"))).drop("text")
    both = _once(both, words="split").drop("split")
    both = both.selectExpr("id", "mark", "item", "words", "item_words", f"explode({_shifts()}) AS shift")
    agree, hits = _agreeing()
    both = _once(both, agree=agree, span=f"least({window}, size(item_words))").drop("words", "item_words")
    places = both.selectExpr("id AS met_id", "mark AS met_mark", "item", f"explode({hits}) AS place").distinct()
    found = places.groupBy("met_id", "met_mark").agg(
        F.count_distinct("place").alias("n_hit"), F.sort_array(F.collect_set("item")).alias("items")
    )
    found = staged(found, "found")
    found = sized.join(found, sized["met_id"].eqNullSafe(found["met_id"]) & (sized["met_mark"] == found["met_mark"]), "left")
    found = staged(found.select(sized["met_id"], sized["met_mark"], F.col("n_words").cast("bigint"), "n_hit", "items"), "labels")
    out = _of_same_row(rows.select("id", "mark"), found, "inner")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        n_hit.alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("bigint").alias("n_items"),
        F.coalesce("items", F.expr("CAST(array() AS array<string>)")).alias("items"),
        ((n_hit > 0) & (n_hit * least_share >= F.col("n_words"))).alias("contaminated"),
        *([F.col("mark").alias(mark_col)] if mark_col else []),
    )
