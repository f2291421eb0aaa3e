"""A distributed positional index of training text, and exact phrase and proximity search from the rarest terms."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.session import settle

#: Words are what these bytes (all ASCII but digits and letters) separate, after A-Z are lower-cased.
APART = "".join(chr(b) for b in range(128) if not (48 <= b < 58 or 97 <= b < 123))
APART_CLASS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
END = "\x00"
NO_ID = -(2**63)
#: So many rows, and bytes of words in them, at most are broadcast.
MAX_BROADCAST, MAX_BYTES = 2_000_000, 64 << 20
KEYS = ["doc", "copy"]


def words_of(text: Column) -> Column:
    """The words of a text, in order; none for a null."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
    inner = F.btrim(low, F.lit(APART))
    return F.when(inner != "", F.split(inner, APART_CLASS)).otherwise(F.array().cast("array<string>"))


def bounded(df: DataFrame) -> DataFrame:
    """A frame of numbers and words marked for broadcast if it is at most so large; else as it is, for a shuffled join."""
    words = [F.octet_length(c) for c, kind in df.dtypes if kind == "string"]
    size = df.limit(MAX_BROADCAST + 1).agg(F.count("*").alias("rows"), F.coalesce(F.sum(sum(words, F.lit(0)).cast("long")), F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if size.rows <= MAX_BROADCAST and size.bytes <= MAX_BYTES else df


@dataclass
class PositionalIndex:
    """postings: term long, doc, copy, pos, on disk; term 0 ends each document and its pos is the number of words.
    terms: term, word, n (how often it occurs), rarest terms first to be searched."""

    postings: DataFrame
    terms: DataFrame


def build_index(docs: DataFrame, vocabulary: DataFrame) -> PositionalIndex:
    """Store the places of every word of `vocabulary` (column word) in every whole text.

    docs: doc_id, text and any others, which are ignored. Words that no search can ask for are not
    stored. A document is told by its id and a hash of id and text, so rows that share an id but not
    the text are searched apart. A null id is kept. The table is in the shared folder; one pass over
    the texts makes it, and searches don't read texts again.
    """
    listed = settle(vocabulary.select("word").where("word is not null").distinct().withColumn("term", F.monotonically_increasing_id() + 1), "vocabulary")
    ends = docs.sparkSession.range(1).select(F.lit(END).alias("word"), F.lit(0).cast("long").alias("term"))
    own = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64("doc_id", "text").alias("copy"),
        F.concat(words_of(F.col("text")), F.array(F.lit(END))).alias("words"),
    )
    placed = own.select("doc", "copy", F.posexplode("words").alias("pos", "word"))
    postings = settle(placed.join(bounded(listed.union(ends)), "word").select("term", "doc", "copy", "pos"), "postings")
    counts = postings.where("term > 0").groupBy("term").agg(F.count("*").alias("n"))
    return PositionalIndex(postings, settle(listed.join(counts, "term", "left").select("term", "word", F.coalesce("n", F.lit(0)).alias("n")), "terms"))


def _ranked(index: PositionalIndex, phrases: DataFrame) -> DataFrame:
    """Terms of the phrases whose words all occur: phrase_id, size, at, term, rank (1: the rarest)."""
    places = phrases.select("phrase_id", F.size("words").alias("size"), F.posexplode("words").alias("at", "word"))
    counted = places.join(bounded(index.terms), "word")
    own = Window.partitionBy("phrase_id")
    alive = counted.withColumn("found", F.count("*").over(own)).withColumn("least", F.min("n").over(own)).where("found = size and least > 0")
    return alive.select("phrase_id", "size", "at", "term", F.row_number().over(own.orderBy("n", "at")).alias("rank"))


def find_phrases(index: PositionalIndex, phrases: DataFrame) -> DataFrame:
    """Every exact occurrence of every phrase: doc, copy, start, phrase_id, size.

    phrases: phrase_id, words (an array; of at least one word). The list of a phrase's rarest word,
    less its place in the phrase, gives the possible starts; those also in the second rarest word's
    list remain. For these, the lists of all words of the phrase are intersected, from postings of
    the documents that are left. A frequent word's list is thus read only where it decides.
    """
    ranked = settle(_ranked(index, phrases), "ranked")
    starts = [index.postings.join(bounded(ranked.where(F.col("rank") == r)), "term").select(*KEYS, (F.col("pos") - F.col("at")).alias("start"), "phrase_id", "size").where("start >= 0") for r in (1, 2)]
    same = [*KEYS, "start", "phrase_id"]
    possible = starts[0].where("size > 1").join(starts[1].select(same), same, "left_semi").distinct()
    single = starts[0].where("size = 1").distinct()
    possible = settle(possible, "candidates")
    inside = index.postings.join(bounded(possible.select(KEYS).distinct()), KEYS, "left_semi")
    asked = possible.join(bounded(ranked.select("phrase_id", "at", "term")), "phrase_id").withColumn("pos", F.col("start") + F.col("at"))
    met = asked.join(inside, ["term", *KEYS, "pos"])
    whole = met.groupBy(*same, "size").agg(F.count_distinct("at").alias("n")).where("n = size").drop("n")
    return settle(whole.select(*same, "size").union(single.select(*same, "size")), "matches")


def find_near(index: PositionalIndex, queries: DataFrame, span: int) -> DataFrame:
    """Where all words of a query stand, in any order, within `span` neighbouring words: doc, copy, query_id, start.

    queries: query_id, words (an array). A posting serves the `span` windows that hold it, so windows
    are intersected as starts of phrases are: those of the rarest word first. start: the first such
    window's, below 0 where it would begin before the text.
    """
    distinct = queries.select(F.col("query_id").alias("phrase_id"), F.array_distinct("words").alias("words"))
    ranked = settle(_ranked(index, distinct), "ranked")
    window = F.explode(F.sequence(F.col("pos") - (span - 1), F.col("pos"))).alias("start")
    first = index.postings.join(bounded(ranked.where("rank = 1")), "term").select(*KEYS, "phrase_id", "size", window).distinct()
    rest = index.postings.join(bounded(ranked), "term").join(bounded(first.select(*KEYS, "phrase_id").distinct()), [*KEYS, "phrase_id"], "left_semi")
    every = rest.select(*KEYS, "phrase_id", "term", window)
    met = first.join(every, [*KEYS, "phrase_id", "start"]).groupBy(*KEYS, "phrase_id", "start", "size").agg(F.count_distinct("term").alias("n")).where("n = size")
    return met.groupBy(*KEYS, F.col("phrase_id").alias("query_id")).agg(F.min("start").alias("start"))


def windows_of(items: DataFrame, width: int) -> DataFrame:
    """item_id, words: each run of `width` words of an item; a shorter item, but not one without words, is one run."""
    own = items.select("item_id", words_of(F.col("text")).alias("all")).where(F.size("all") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("all") - (width - 1), F.lit(1)))).alias("first")
    return own.select("item_id", "all", starts).select("item_id", F.slice("all", F.col("first"), width).alias("words"))


def contamination(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """How much of each document stands in the test items: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    docs: doc_id, text; items: item_id, text; other columns are ignored. n_hit: words inside any
    occurrence of any window of `width` words of an item. n_items: items with occurring windows;
    items_sha256: of their ids, sorted as strings and joined by commas. A row for each row of docs;
    null and empty texts have no words, and items without words no windows. Windows that several
    items share are searched once.
    """
    runs = windows_of(items, width)
    texts = settle(runs.groupBy("words").agg(F.collect_set(F.col("item_id").cast("string")).alias("items")).withColumn("phrase_id", F.monotonically_increasing_id()), "windows")
    index = build_index(docs, texts.select(F.explode("words").alias("word")))
    matches = find_phrases(index, texts.select("phrase_id", "words"))
    covered = matches.select(*KEYS, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("size") - 1)).alias("pos")).distinct()
    hits = covered.groupBy(*KEYS).agg(F.count("*").alias("n_hit"))
    owners = bounded(texts.select("phrase_id", F.explode("items").alias("item")))
    found = matches.select(*KEYS, "phrase_id").distinct().join(owners, "phrase_id").groupBy(*KEYS).agg(F.array_sort(F.collect_set("item")).alias("items"))
    rows = index.postings.where("term = 0").select(*KEYS, F.col("pos").cast("long").alias("n_words"))
    joined = rows.join(hits, KEYS, "left").join(found, KEYS, "left")
    items_found = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0))
    return joined.select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"),
        "n_words",
        n_hit.cast("long").alias("n_hit"),
        F.size(items_found).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_found, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, width: int = 10, share: float = 0.0, least: int = 5, short_share: float | None = None) -> DataFrame:
    """The rows of docs without documents of which more than `share` of the words stand in the items.

    That an item of fewer than `least` words occurs says little about a document, so `share` leaves
    these out: a document goes for them only if more than `short_share` of its words stand in such
    items, and never if that is None. An id that any contaminated document has goes; rows with a null id
    stay.
    """
    size = F.size(words_of(F.col("text")))

    def beyond(some: DataFrame, most: float) -> DataFrame:
        found = contamination(docs, some, width)
        return found.where(F.col("contaminated") & (F.col("n_hit") > F.lit(most) * F.col("n_words"))).select("doc_id")

    gone = beyond(items.where(size >= least), share)
    short = items.where((size > 0) & (size < least))
    if short_share is not None and not short.isEmpty():
        gone = gone.union(beyond(short, short_share))
    return docs.join(gone.distinct(), "doc_id", "left_anti")
