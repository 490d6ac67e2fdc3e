"""Term statistics (T5-T10) over a document table.

A document becomes its terms with their counts inside the scan: the text is
tokenised once, the query vocabulary is tested on the token array, and what passes
is sorted and counted there.  Nothing is exchanged for it: tokens never leave the
task that read the text, and a document gives one row whatever its length.  The
collection statistics are sums over these rows.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.membership import SET_MEMBERS, Membership, membership
from ..functions.text import STOP_WORDS, query_text, tokenize
from ..session import cut_lineage, keep


def query_terms(topics: DataFrame, kind: str = "short", stop_words=STOP_WORDS,
                keep_description_label: bool = True) -> DataFrame:
    """T5: (qid, term, qtf, first_pos) per topic; qtf counts repeats (library
    models), first_pos keeps first-seen order (custom model)."""
    text = query_text(kind, keep_description_label)
    toks = topics.select("qid", F.posexplode(tokenize(text, stop_words)).alias("p", "term"))
    return toks.groupBy("qid", "term").agg(F.count(F.lit(1)).alias("qtf"),
                                           F.min("p").alias("first_pos"))


@dataclass
class CollectionStats:
    """Number of documents and of tokens, average length."""
    num_docs: int
    total_tokens: int

    @property
    def avgdl(self) -> float:
        return self.total_tokens / self.num_docs if self.num_docs else 0.0


def doc_lengths(docs: DataFrame, stop_words=STOP_WORDS) -> DataFrame:
    """(docno, dl) = number of index terms per document."""
    return docs.select("docno", F.size(tokenize(F.col("text"), stop_words)).alias("dl"))


def doc_terms(docs: DataFrame, vocab: Membership | None = None, stop_words=STOP_WORDS) -> DataFrame:
    """(docno, dl, terms): one row per document with its terms and their counts, an
    array of (term, tf) in term order, restricted to `vocab` when given.

    Equal tokens are neighbours once sorted, so a term's count is the distance
    between the places where terms begin.  Each step is a projection of its own:
    what it makes is used more than once by the next, so it is computed once."""
    tokens = docs.select("docno", tokenize(F.col("text"), stop_words).alias("_tokens"))
    own = F.col("_tokens")
    if vocab is not None:
        own = F.filter(own, vocab.test)
    found = tokens.select("docno", F.size("_tokens").alias("dl"), F.sort_array(own).alias("_s"))
    begins = found.select("docno", "dl", "_s", F.expr(
        "filter(if(size(_s) > 0, sequence(0, size(_s) - 1), array()), "
        "i -> i = 0 OR get(_s, i) <> get(_s, i - 1))").alias("_b"))
    return begins.select("docno", "dl", F.expr(
        "transform(_b, (b, k) -> named_struct('term', get(_s, b), "
        "'tf', cast(coalesce(get(_b, k + 1), size(_s)) - b AS bigint)))").alias("terms"))


def _rows(index: DataFrame, vocab: Membership | None) -> DataFrame:
    """(docno, dl, term, tf) of the rows of `doc_terms`.  Terms that an inexact
    test let through are removed by a join of the counted survivors.  (The outer
    form of inline keeps the planner from testing, and so computing, each document's
    terms a second time.)"""
    out = index.select("docno", "dl", F.inline_outer("terms")).where(F.col("term").isNotNull())
    if vocab is not None and not vocab.exact:
        out = out.join(vocab.members.select(F.col(vocab.name).alias("term")), "term", "left_semi")
    return out.select("docno", "dl", "term", "tf")


def postings(docs: DataFrame, vocab: DataFrame | None = None, stop_words=STOP_WORDS,
             set_members: int = SET_MEMBERS) -> DataFrame:
    """(docno, dl, term, tf), restricted to `vocab(term)` when given; a vocabulary
    of more than `set_members` terms is tested by a Bloom filter, then exactly."""
    test = membership(vocab, "term", set_members) if vocab is not None else None
    return _rows(doc_terms(docs, test, stop_words), test)


def index_for(docs: DataFrame, vocab: DataFrame, stop_words=STOP_WORDS,
              checkpoint: bool = False):
    """Pruned postings plus the exact collection statistics from one pass over the
    document text: the rows of `doc_terms` are persisted (or checkpointed to the
    shared folder when `checkpoint`), and both are read from them.

    The rows are dealt by document before they are persisted, so what is summed or
    ordered per (topic, document) afterwards stays in the task that holds the document:
    one row a document is exchanged, not one per topic that it matches."""
    test = membership(vocab, "term")
    index = doc_terms(docs, test, stop_words).repartition("docno")
    index = cut_lineage(index) if checkpoint else keep(index)
    r = index.agg(F.count(F.lit(1)).alias("n"), F.sum("dl").alias("t")).first()
    return _rows(index, test), CollectionStats(int(r["n"] or 0), int(r["t"] or 0))


def term_stats(post: DataFrame) -> DataFrame:
    """(term, df, ttf) over the (pruned) postings."""
    return post.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("ttf"))
