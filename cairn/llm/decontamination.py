"""Benchmark decontamination over a distributed positional inverted index.

The index holds a posting (term, document, position) for every word of the
corpus.  It is partitioned by documents: each task writes the postings of its
own documents, sorted by term, so nothing moves and a lookup of few terms reads
few pages of each part.  A test phrase is looked up through the lists of its
rarest terms: both lists, each less its term's offset in the phrase, are
intersected, and what is left is compared word by word with the document, for
exact phrases in place and for near ones within a span.  Everything is made of
DataFrame and SQL functions.

A term is the 64-bit hash of a word; equal hashes of different words cost a
comparison and change no result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.quality import bind
from cairn.llm.rows import ROW, with_row_numbers
from cairn.llm.scratch import Scratch

#: Words of a test window, and test terms whose lists are intersected before documents are read.
WINDOW = 10
LISTS = 2
#: A table of test terms or windows with at most this many rows is sent to all tasks; a larger one is joined by shuffling.
BROADCAST_ROWS = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_array(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z; null and empty texts have none."""
    text = F.coalesce(text, F.lit(""))
    plain = F.length(text) == F.octet_length(text)  # lower() is quicker, and the same where all is ASCII
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.filter(F.split(low, _GAPS), lambda w: w != "")


@dataclass
class PositionalIndex:
    """``documents``: row number and text of each document; ``postings``: term, doc and pos (from 0) of each of its words."""

    documents: DataFrame
    postings: DataFrame
    scratch: Scratch

    def lists_of(self, terms: DataFrame) -> DataFrame:
        """Postings of the terms in ``terms`` (column ``term`` and others), with the others."""
        return self.postings.join(_sent(terms), "term")

    def frequencies(self, terms: DataFrame) -> DataFrame:
        """``term``, ``n``: postings of each of the given distinct terms; absent ones have no row."""
        return self.lists_of(terms).groupBy("term").agg(F.count(F.lit(1)).alias("n"))

    def word_counts(self) -> DataFrame:
        """``doc``, ``n_words`` of documents that have words; each is counted where its postings lie."""
        return self.postings.groupBy("doc").agg(F.count(F.lit(1)).alias("n_words"))


def _sent(small: DataFrame) -> DataFrame:
    """``small`` (a written table) for a join: sent to all tasks if its counted rows allow that."""
    return F.broadcast(small) if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else small


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> PositionalIndex:
    """Index all words of all documents.

    Null and empty texts have no postings.  Rows with a null or repeated id are
    documents of their own.  An empty table gives an empty index.  Further columns,
    whatever their names, are not read.
    """
    scratch = Scratch(docs.sparkSession, "index")
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = with_row_numbers(plain, scratch).select(F.col(ROW).alias("doc"), "doc_id", "text")
    postings = rows.select("doc", F.posexplode(word_array(F.col("text"))).alias("pos", "word")).select(
        F.xxhash64("word").alias("term"), "doc", "pos")
    return PositionalIndex(rows, scratch.cut(postings.sortWithinPartitions("term"), "postings"), scratch)


def windows_of(items: DataFrame, scratch: Scratch, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Test phrases and the items that hold them.

    The first table has one row per distinct phrase: ``phrase`` (its words joined by
    spaces), ``n``; the second ``phrase``, ``item``.  A phrase is ``size`` consecutive
    words of an item, or all of a shorter item; items without words have none.  A null id is
    written as an empty text; rows of one id are one item.
    """
    words = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), word_array(F.col(text_col)).alias("w"))
    last = F.greatest(F.size("w") - size, F.lit(0))
    held = words.where(F.size("w") > 0).select("item", F.explode(
        F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(F.col("w"), i + 1, size), " "))).alias("phrase"))
    held = scratch.cut(held.distinct(), "held")
    return scratch.cut(held.select("phrase").distinct().withColumn("n", F.size(F.split("phrase", " "))), "phrases"), held


def rarest_terms(index: PositionalIndex, phrases: DataFrame, lists: int = LISTS) -> DataFrame:
    """``phrase``, ``n``, ``term``, ``offset``, ``turn``: the rarest terms of each phrase, the rarest at turn 1.

    Each of a phrase's terms is taken at its first place; ties go to the smaller term.  A phrase
    with a term that the corpus lacks occurs nowhere and has no row.
    """
    terms = phrases.select("phrase", "n", F.posexplode(F.split("phrase", " ")).alias("offset", "word")).groupBy(
        "phrase", "n", F.xxhash64("word").alias("term")).agg(F.min("offset").alias("offset"))
    distinct = index.scratch.cut(terms.select("term").distinct(), "terms")
    counted = terms.join(index.scratch.cut(index.frequencies(distinct).withColumnRenamed("n", "postings"), "frequencies"), "term", "left")
    of_phrase = Window.partitionBy("phrase")
    ranked = counted.withColumn("absent", F.max(F.col("postings").isNull()).over(of_phrase)).withColumn(
        "turn", F.row_number().over(of_phrase.orderBy("postings", "term")))
    return index.scratch.cut(ranked.where(~F.col("absent") & (F.col("turn") <= lists)).select("phrase", "n", "term", "offset", "turn"), "rarest")


def phrase_matches(index: PositionalIndex, phrases: DataFrame) -> DataFrame:
    """``doc``, ``phrase``, ``start``, ``n``: every place where a phrase occurs word by word.

    The lists of a phrase's two rarest terms, less their offsets, are intersected by
    (document, phrase, start); the words at what is left are then compared.
    """
    rare = rarest_terms(index, phrases)
    numbered = index.scratch.cut(phrases.select("phrase").withColumn("id", F.monotonically_increasing_id()), "numbers")
    # lists carry a number for the phrase
    rare = index.scratch.cut(rare.join(numbered, "phrase"), "leads")
    single = rare.groupBy("id").agg(F.max("turn").alias("lists"))
    rare = index.scratch.cut(rare.join(single, "id").select("id", "term", "offset", "turn", "lists"), "leads")

    def starts(turn: int) -> DataFrame:
        found = index.lists_of(index.scratch.cut(rare.where(F.col("turn") == turn), "list"))
        return found.select("doc", "id", (F.col("pos") - F.col("offset")).alias("start"), "lists").where("start >= 0")

    first = starts(1)
    both = first.where("lists > 1").drop("lists").join(starts(2).drop("lists"), ["doc", "id", "start"], "left_semi")
    left = first.where("lists = 1").drop("lists").unionByName(both)
    texts = _sent(index.scratch.cut(numbered.join(phrases, "phrase"), "texts"))
    asked = left.join(texts, "id").groupBy("doc").agg(F.collect_list(F.struct("start", "n", "phrase")).alias("asked"))
    checked = index.documents.select("doc", "text").join(asked, "doc").select("doc", bind(
        word_array(F.col("text")), lambda w: F.filter("asked", lambda a: F.array_join(F.slice(w, a["start"] + 1, a["n"]), " ") == a["phrase"])).alias("hits"))
    return checked.select("doc", F.explode("hits").alias("h")).select("doc", "h.phrase", "h.start", "h.n")


def proximity_matches(index: PositionalIndex, phrases: DataFrame, slop: int) -> DataFrame:
    """``doc``, ``phrase``, ``pos``: places of a phrase's rarest term where all its words stand near.

    Near: some n + ``slop`` consecutive words of the document (n: words of the phrase), or
    all of a shorter document, hold the place and every distinct word of the phrase, in any
    order.  The lists of the two rarest terms are met by stretches of that many words before
    words are compared.
    """
    rare = rarest_terms(index, phrases)
    span = F.col("n") + slop
    first = index.lists_of(index.scratch.cut(rare.where("turn = 1").withColumn("span", span).drop("turn", "offset"), "list"))
    second = index.lists_of(index.scratch.cut(rare.where("turn = 2").withColumn("span", span).select("phrase", "term", "span"), "list"))
    # a second term within span - 1 words lies in the same stretch or a neighbouring one
    met = second.select("doc", "phrase", F.explode(F.array(*(F.floor(F.col("pos") / F.col("span")) + i for i in (-1, 0, 1)))).alias("stretch")).distinct()
    alone = rare.groupBy("phrase").agg(F.max("turn").alias("lists")).where("lists = 1").select("phrase")
    stretched = first.withColumn("stretch", F.floor(F.col("pos") / F.col("span")))
    left = stretched.join(met, ["doc", "phrase", "stretch"], "left_semi").unionByName(stretched.join(alone, "phrase", "left_semi"), allowMissingColumns=True)
    asked = left.groupBy("doc").agg(F.collect_list(F.struct("pos", "span", "phrase")).alias("asked"))

    def near(words: Column, a: Column) -> Column:
        wanted = F.split(a["phrase"], " ")
        begins = F.sequence(F.greatest(a["pos"] - a["span"] + 1, F.lit(0)), a["pos"])
        return F.exists(begins, lambda s: F.size(F.array_except(wanted, F.slice(words, s + 1, a["span"]))) == 0)

    checked = index.documents.select("doc", "text").join(asked, "doc").select(
        "doc", bind(word_array(F.col("text")), lambda w: F.filter("asked", lambda a: near(w, a))).alias("hits"))
    return checked.select("doc", F.explode("hits").alias("h")).select("doc", "h.phrase", "h.pos")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``.

    A word is hit where it lies in any occurrence of a window of any item.  ``n_items``
    counts the items of which a window occurs, ``items_sha256`` hashes their ids, sorted as
    texts and joined by commas.

    Null texts have no words; null and repeated document ids are documents of their own; an
    empty table of documents gives no rows, one of items no hits.  A null item id counts as an
    empty text, rows of one item id are one item.  Further columns, whatever their names, are
    not read.
    """
    index = build_index(docs, id_col, text_col)
    phrases, held = windows_of(items, index.scratch, item_col, item_text_col, size)
    found = index.scratch.cut(phrase_matches(index, phrases), "matches")
    covered = found.groupBy("doc").agg(F.collect_set(F.struct("start", "n")).alias("at"))
    hit = covered.select("doc", F.size(F.array_distinct(F.flatten(F.transform(
        "at", lambda a: F.sequence(a["start"], a["start"] + a["n"] - 1))))).cast("long").alias("n_hit"))
    named = found.select("doc", "phrase").distinct().join(_sent(held), "phrase").groupBy("doc").agg(F.sort_array(F.collect_set("item")).alias("ids"))
    out = index.documents.select("doc", "doc_id").join(index.word_counts(), "doc", "left").join(hit, "doc", "left").join(named, "doc", "left")
    return out.select(
        "doc_id", F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))
