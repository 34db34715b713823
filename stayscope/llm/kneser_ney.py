"""Quality by the perplexity of an n-gram model of trusted text.

The model is an interpolated modified Kneser-Ney model over the UTF-16 units of
a text, of order four: four units fit in one 64-bit key. Training counts come
from all trusted texts. Every distinct n-gram of the table gets its probability
from joins of the count tables, sharded by key; documents then sum the
probabilities of their n-grams. A document is rejected if its perplexity, or
that of its least likely word, is above the quantile of its language's trusted
documents, each scored by a model without its own fold of the trusted texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stayscope.llm.batches import bound_batches, slices
from stayscope.llm.components import kept
from stayscope.llm.tables import most_frequent
from stayscope.session import shared_folder

ORDER = 4
#: Sent to every task: 12 bytes for each n-gram, and 4 more for each fold.
TABLE_BYTES = 64 << 20
ENTRY_BYTES = 12
FOLD_BYTES = 4
#: A word, with the blank after it, is cut after so many units; scripts without blanks have pieces instead.
WORD_UNITS = 24
#: Certain units added to a word, as the perplexity of one or two units says little.
WORD_PRIOR = 2
_BLANK = np.zeros(1 << 16, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32, 0xA0, 0x3000]] = True
#: N-grams tallied in a task before they are handed on.
TALLIED = 300_000
#: Texts handled at once in a task: every unit takes several arrays of 64-bit numbers.
SLICE = 256 << 10
#: Ids sent to every task to mark trusted rows; more of them are joined by a shuffle.
BROADCAST_IDS = 4_000_000
#: Before and after a text stand control units.
BEFORE, AFTER = "\x02" * (ORDER - 1), "\x03"
#: Where a table has too few distinct counts to estimate discounts (counts 1, 2, 3 and more).
USUAL_DISCOUNTS = (0.5, 1.0, 1.5)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all n-grams, text after text, and where those of each text begin (with the end)."""
    coded = [(BEFORE + text + AFTER).encode("utf-16-le") for text in texts]
    units = np.frombuffer(b"".join(coded), dtype="<u2").astype(np.uint64)
    size = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) // 2
    key = units[ORDER - 1:].copy()
    for back in range(1, ORDER):
        key |= units[ORDER - 1 - back:len(units) - back] << np.uint64(16 * back)
    # An n-gram that starts in one text and ends in the next is none.
    begin = np.cumsum(size) - size
    whole = np.ones(len(key), dtype=bool)
    for back in range(1, ORDER):
        whole[begin[1:] - back] = False
    return key[whole], np.concatenate(([0], np.cumsum(size - ORDER + 1)))


def _words(found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where each word's first n-gram stands; an n-gram belongs to the word of its last unit."""
    start = np.zeros(len(found), dtype=bool)
    start[1:] = _BLANK[(found[:-1] & np.uint64(0xFFFF)).astype(np.int64)]
    start[bounds[:-1]] = True
    begin = np.flatnonzero(start)
    place = np.arange(len(found)) - np.repeat(begin, np.diff(np.append(begin, len(found))))
    return np.flatnonzero(place % WORD_UNITS == 0)


def _tally(texts: DataFrame, folds: int = 0) -> DataFrame:
    """key, n (in trusted texts), n1, n2, ... (in each fold of them) and freq (lots that hold it) of every distinct n-gram."""
    names = ["n", *(f"n{f}" for f in range(1, folds + 1)), "freq"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def put_together() -> None:
            keys = np.concatenate([h[0] for h in held])
            distinct, place = np.unique(keys, return_inverse=True)
            sums = [np.bincount(place, weights=np.concatenate([h[k] for h in held])).astype(np.int64)
                    for k in range(1, len(names) + 1)]
            held[:] = [(distinct, *sums)]

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(held[0][0].view(np.int64)), *map(pa.array, held[0][1:])], names=["key", *names]
            )

        for batch in batches:
            for part in slices(batch, limit=SLICE):
                keys, bounds = grams(part.column("text").to_pylist())
                trusted = np.repeat(part.column("trusted").to_numpy(zero_copy_only=False), np.diff(bounds))
                fold = np.repeat(part.column("fold").to_numpy(), np.diff(bounds))
                distinct, place = np.unique(keys, return_inverse=True)
                chosen = [trusted, *(fold == f for f in range(1, folds + 1))]
                n = [np.bincount(place[which], minlength=len(distinct)).astype(np.int64) for which in chosen]
                held.append((distinct, *n, np.ones(len(distinct), np.int64)))
                if sum(len(h[0]) for h in held) > TALLIED:
                    put_together()
                    if len(held[0][0]) > TALLIED // 2:
                        yield rows()
                        held.clear()
        if held:
            put_together()
            yield rows()

    tallied = texts.select("text", "trusted", "fold").mapInArrow(run, ", ".join(f"{c} bigint" for c in ["key", *names]))
    return tallied.groupBy("key").agg(*(F.sum(c).alias(c) for c in names))


def discounts(counts: DataFrame, folds: int = 0) -> list[tuple[float, float, float]]:
    """For each model, what is taken from counts of one, two, and three or more: the estimate from counts of counts."""
    models = range(folds + 1)
    found = counts.agg(*(F.count_if(F.col(f"n{m}") == i).alias(f"m{m}_{i}") for m in models for i in (1, 2, 3, 4))).first()
    out = []
    for m in models:
        n = [0, *(found[f"m{m}_{i}"] for i in (1, 2, 3, 4))]
        if not all(n[1:]):
            out.append(USUAL_DISCOUNTS)
            continue
        y = n[1] / (n[1] + 2 * n[2])
        out.append(tuple(min(float(i), max(0.0, i - (i + 1) * y * n[i + 1] / n[i])) for i in (1, 2, 3)))
    return out


def _suffix(order: int):
    return F.col("key").bitwiseAND(F.lit((1 << 16 * order) - 1))


def _probabilities(asked: DataFrame, counts: DataFrame, lower: DataFrame, order: int, folds: int) -> DataFrame:
    """key and p0, p1, ... of every asked n-gram of an order, from its counts and the probabilities of the order below.

    `asked` has the key, `counts` key and n0, n1, ...; `lower` key and p0, p1,
    ..., or for order one a single row of them under the key 0.
    """
    models = range(folds + 1)

    def taken(m: int):
        n, (d1, d2, d3) = F.col(f"n{m}"), cuts[m]
        return F.when(n == 1, d1).when(n == 2, d2).when(n > 2, d3).otherwise(0.0)

    def p(m: int):
        n, total, below = F.col(f"n{m}"), F.col(f"total{m}"), F.col(f"below{m}")
        own = F.when(n > 0, F.greatest(n - taken(m), F.lit(0.0))).otherwise(0.0)
        return F.when(total > 0, (own + F.col(f"spread{m}") * below) / total).otherwise(below)

    cuts = discounts(counts, folds)
    contexts = counts.groupBy(F.shiftrightunsigned("key", 16).alias("context")).agg(
        *(F.sum(f"n{m}").alias(f"total{m}") for m in models), *(F.sum(taken(m)).alias(f"spread{m}") for m in models)
    )
    rows = asked.select("key", F.shiftrightunsigned("key", 16).alias("context"), _suffix(order - 1).alias("rest"))
    rows = rows.join(counts, "key", "left").join(contexts, "context", "left")
    rows = rows.join(lower.select(F.col("key").alias("rest"), *(F.col(f"p{m}").alias(f"below{m}") for m in models)), "rest")
    return rows.select("key", *(p(m).alias(f"p{m}") for m in models))


def log_probabilities(tally: DataFrame, folder: str, folds: int = 0) -> DataFrame:
    """key, freq and logp0, logp1, ... (natural) of every distinct n-gram of the table.

    Model 0 is counted from all trusted texts, model f from those outside fold
    f. The highest order has the texts' counts; below it, an n-gram's
    count is the number of different units before it. Units not seen in
    trusted text share what the lowest order gives away, equally over all
    units of the table. Without trusted text all units are equally likely.
    """
    spark = tally.sparkSession
    models = range(folds + 1)
    without = ((F.col("n") - F.col(f"n{f}")).alias(f"n{f}") for f in models[1:])
    counts = {ORDER: tally.filter("n > 0").select("key", F.col("n").alias("n0"), *without)}
    asked = {ORDER: tally.select("key")}
    for order in range(ORDER - 1, 0, -1):
        above = counts[order + 1].groupBy(_suffix(order).alias("key"))
        counts[order] = kept(above.agg(*(F.count_if(F.col(f"n{m}") > 0).alias(f"n{m}") for m in models)), f"{folder}/counts{order}")
        asked[order] = kept(asked[order + 1].select(_suffix(order).alias("key")).distinct(), f"{folder}/asked{order}")
    units = max(1, asked[1].count())
    lower = spark.createDataFrame([(0, *[1.0 / units] * len(models))], "key bigint" + "".join(f", p{m} double" for m in models))
    for order in range(1, ORDER + 1):
        lower = kept(_probabilities(asked[order], counts[order], lower, order, folds), f"{folder}/p{order}")
    return tally.join(lower, "key").select("key", "freq", *(F.log(f"p{m}").alias(f"logp{m}") for m in models))


def totals(texts: DataFrame, logs: DataFrame, folder: str, table_bytes: int = TABLE_BYTES, folds: int = 0) -> DataFrame:
    """The rows of `texts` (doc_id, lang, text, trusted, fold) without the text, with what their n-grams say.

    n is the number of n-grams, total their log probability, worst the highest
    negative log probability a unit of a word. held and held_worst are the
    same by the model without the row's fold; without a fold they do not differ.

    The most frequent n-grams, as many as fit in `table_bytes`, are joined
    where the texts are; the others by a shuffle of (text, word, n-gram, count).
    """
    names = [f"logp{m}" for m in range(folds + 1)]
    which, every = most_frequent(logs, table_bytes // (ENTRY_BYTES + FOLD_BYTES * folds))
    keys, values = np.empty(0, np.uint64), np.empty((len(names), 0), np.float32)
    if which is not None:
        table = logs.filter(which).select("key", *(F.col(c).cast("float") for c in names)).toArrow()
        keys = table["key"].to_numpy().view(np.uint64)
        order = np.argsort(keys)
        keys, values = keys[order], np.stack([table[c].to_numpy()[order] for c in names])
    sent = texts.sparkSession.sparkContext.broadcast((keys, values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, logs_of = sent.value
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                found, bounds = grams(part.column("text").to_pylist())
                fold = part.column("fold").to_numpy()
                at = np.minimum(np.searchsorted(known, found), max(len(known) - 1, 0))
                there = known[at] == found if len(known) else np.zeros(len(found), bool)
                begin = _words(found, bounds)
                sizes = np.diff(np.append(begin, len(found)))
                whole = np.logical_and.reduceat(there, begin)
                text_begin = np.searchsorted(begin, bounds[:-1])
                sums, parts, worst = [], [], []
                for model in (np.zeros(len(found), np.int64), np.repeat(fold, np.diff(bounds))):
                    value = np.where(there, logs_of[model, at], 0.0) if len(known) else np.zeros(len(found))
                    sums.append(np.add.reduceat(value, bounds[:-1], dtype=np.float64))
                    parts.append(np.add.reduceat(value, begin, dtype=np.float64))
                    # A word with n-grams outside the table is judged when they are joined.
                    worst.append(np.maximum.reduceat(np.where(whole, -parts[-1] / (sizes + WORD_PRIOR), 0.0), text_begin))
                yield pa.RecordBatch.from_arrays([
                    *(part.column(c) for c in ("doc_id", "lang", "trusted", "fold", "text_key")),
                    pa.array(np.diff(bounds), pa.int64()), *map(pa.array, sums), *map(pa.array, worst),
                    _rest(found, there, bounds, begin, sizes, parts),
                ], names=["doc_id", "lang", "trusted", "fold", "text_key", "n", "total", "held", "worst", "held_worst", "rest"])

    scored = texts.withColumn("text_key", F.xxhash64("text")).mapInArrow(
        run, "doc_id bigint, lang string, trusted boolean, fold int, text_key bigint, n bigint, total double, held double, "
        "worst double, held_worst double, "
        "rest array<struct<key: bigint, freq: bigint, word: bigint, size: bigint, part: double, held_part: double>>"
    )
    if not every:
        scored = kept(scored, f"{folder}/scored")
        text = ["text_key", "n", "fold"]
        # In single precision as in the table, so that no verdict depends on what fits there.
        logs = logs.select("key", *(F.col(c).cast("float").cast("double").alias(c) for c in names))
        more = scored.dropDuplicates(text).select(*text, F.inline("rest")).join(logs, "key")
        own = F.element_at(F.array(*names), F.col("fold") + 1)
        words = more.groupBy(*text, "word").agg(
            F.sum(F.col("freq") * F.col("logp0")).alias("more"), F.sum(F.col("freq") * own).alias("held_more"),
            F.max("size").alias("size"), F.max("part").alias("part"), F.max("held_part").alias("held_part"),
        )
        least = F.col("size") + WORD_PRIOR
        more = words.groupBy(*text).agg(
            F.sum("more").alias("more"), F.sum("held_more").alias("held_more"),
            F.max(-(F.col("part") + F.col("more")) / least).alias("more_worst"),
            F.max(-(F.col("held_part") + F.col("held_more")) / least).alias("more_held_worst"),
        )
        scored = scored.join(more, text, "left").withColumns(
            {c: F.col(c) + F.coalesce(x, F.lit(0.0)) for c, x in (("total", "more"), ("held", "held_more"))}
            | {c: F.greatest(c, f"more_{c}") for c in ("worst", "held_worst")}
        )
    # A text without units has nothing to judge: only the end would be predicted.
    figures = (F.when(F.col("n") > 1, F.col(c)).alias(c) for c in ("total", "held", "worst", "held_worst"))
    return scored.select("doc_id", "lang", "trusted", "text_key", "n", *figures)


def _rest(
    found: np.ndarray, there: np.ndarray, bounds: np.ndarray, begin: np.ndarray, sizes: np.ndarray, parts: list[np.ndarray]
) -> pa.Array:
    """For each text, its n-grams outside the table by word, with their counts and what else the word has."""
    names = ["key", "freq", "word", "size", "part", "held_part"]
    kind = pa.list_(pa.struct([(c, pa.int64() if c in names[:4] else pa.float64()) for c in names]))
    if there.all():
        return pa.array([[]] * (len(bounds) - 1), kind)
    gone = np.flatnonzero(~there)
    word = np.searchsorted(begin, gone, side="right") - 1
    pairs, freq = np.unique(np.stack([word, found[gone].view(np.int64)]), axis=1, return_counts=True)
    word, key = pairs
    of_text = np.searchsorted(bounds, begin[word], side="right") - 1
    columns = [key, freq, word, sizes[word], parts[0][word], parts[1][word]]
    flat = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(kind.value_type))
    ends = np.concatenate(([0], np.cumsum(np.bincount(of_text, minlength=len(bounds) - 1))))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)


def with_trust(
    docs: DataFrame, trusted_ids: DataFrame, id_col: str, text_col: str, lang_col: str, folds: int = 0
) -> DataFrame:
    """doc_id, lang, text, trusted and fold; the ids are sent to the tasks if few enough, else joined by a shuffle.

    Trusted rows have a fold from 1, by a hash of the text so that copies share it; others have 0.
    """
    rows = docs.select(
        docs[id_col].cast("bigint").alias("doc_id"), docs[lang_col].cast("string").alias("lang"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
    )
    ids = trusted_ids.select(F.col(trusted_ids.columns[0]).cast("bigint").alias("doc_id")).dropna().distinct()
    ids = ids.withColumn("yes", F.lit(True))
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    fold = F.when(F.col("yes"), 1 + F.pmod(F.xxhash64("text"), F.lit(folds))) if folds else F.lit(None)
    return rows.join(ids, "doc_id", "left").select(
        "doc_id", "lang", "text", F.col("yes").isNotNull().alias("trusted"), F.coalesce(fold, F.lit(0)).cast("int").alias("fold")
    )


def judge(
    docs: DataFrame, trusted_ids: DataFrame, quantile: float = 0.995, prior: int = 50, id_col: str = "doc_id",
    text_col: str = "text", lang_col: str = "lang", table_bytes: int = TABLE_BYTES, folds: int = 0,
    word_quantile: float | None = None,
) -> DataFrame:
    """doc_id, text_key (a hash of the text), lang, perplexity, score, threshold and keep of every document.

    `trusted_ids` names the trusted documents in its first column. `score` is
    the perplexity with `prior` n-grams of the language's trusted average
    added, since that of a few words says little. The threshold of a language
    is that quantile of its trusted documents' scores; a language without
    trusted documents, and the null language, take the average and the
    threshold over all. Kept is what is not above the threshold.

    With `folds` (two or more), averages and thresholds come from held-out
    scores: each trusted document is scored by the trusted texts outside its
    fold. A language without trusted documents, and the null language, then
    have no threshold and all their texts with content are kept.

    With `word_quantile`, a text is also dropped if the perplexity of its
    least likely word (word_score) is above that quantile of its language's
    trusted documents (word_threshold).

    A null or empty text has no perplexity and is not kept. Without any
    trusted document there is no threshold and every text with content is
    kept. Repeated rows are each judged, a null id is judged but never
    trusted, other columns are left behind.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    folder = shared_folder(spark)
    if folds == 1:
        raise ValueError("one fold leaves no trusted text to score it by")
    texts = with_trust(docs, trusted_ids, id_col, text_col, lang_col, folds)
    tally = kept(_tally(texts, folds), f"{folder}/tally")
    logs = kept(log_probabilities(tally, folder, folds), f"{folder}/logs")
    scored = kept(totals(texts, logs, folder, table_bytes, folds), f"{folder}/totals")
    return _thresholds(scored, quantile, prior, folds > 0, word_quantile)


def _thresholds(
    scored: DataFrame, quantile: float, prior: int, own_only: bool = False, word_quantile: float | None = None
) -> DataFrame:
    average = (F.sum("held") / F.sum("n")).alias("average")

    def with_own(rows: DataFrame, table: DataFrame, column: str, own_only: bool = False) -> DataFrame:
        """The column from the language's row, else, unless only its own counts, from the row over all (without a language)."""
        own, over_all = table.filter("lang is not null"), table.filter("lang is null").select(F.col(column).alias("over_all"))
        joined = rows.join(F.broadcast(own), "lang", "left")
        if own_only:
            return joined
        joined = joined.join(F.broadcast(over_all))
        return joined.withColumn(column, F.coalesce(column, "over_all")).drop("over_all")

    def by_language(rows: DataFrame, value) -> DataFrame:
        """A value per language, and one over all under the null language. Both are a row per language."""
        one = rows.filter("lang is not null").groupBy("lang").agg(value)
        return one.unionByName(rows.agg(value).withColumn("lang", F.lit(None).cast("string")))

    trusted = scored.filter("trusted and total is not null")
    rows = with_own(scored, by_language(trusted, average), "average")

    def score(total: str):
        return F.exp(-(F.col(total) + prior * F.coalesce("average", F.lit(0.0))) / (F.col("n") + prior))

    rows = rows.withColumns({
        "score": score("total"), "held_score": score("held"), "word_score": F.exp("worst"), "held_word_score": F.exp("held_worst"),
    })
    keep, shown = F.col("score").isNotNull(), ["score", "threshold"]
    limits = [("score", "threshold", quantile)]
    if word_quantile is not None:
        limits.append(("word_score", "word_threshold", word_quantile))
        shown += ["word_score", "word_threshold"]
    trusted = rows.filter("trusted and total is not null")
    for figure, limit, share in limits:
        cut = F.percentile_approx(f"held_{figure}", share, 10_000).alias(limit)
        rows = with_own(rows, by_language(trusted, cut), limit, own_only)
        keep &= F.col(limit).isNull() | (F.col(figure) <= F.col(limit))
    perplexity = F.exp(-F.col("total") / F.col("n"))
    return rows.select("doc_id", "text_key", "lang", perplexity.alias("perplexity"), *shown, keep.alias("keep"))
