"""Quality rules: one table of thresholds compiled into one projection.

Counts come from the whole text by built-in functions alone; a rule compares a
ratio of two of them with a threshold.  A document is kept when it passes the
base rules and every row of the table.

Defined cases: a null text counts as empty (no words, so the base fails);
repeated rows are judged one by one; an empty table gives an empty result.
Columns other than doc_id and text are not read, whatever their names.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from judgeline.llm.common import WORD

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Very common function words of four languages.
STOP_WORDS = (
    "the of and to in is that it for on with as was by be this are at from or an "
    "der die das und ist von mit den nicht zu ein eine auf für im dem des sich "
    "le la les de des et est en du une un que pour dans par sur au pas "
    "el los las y en del se por con una para es su al lo como más"
).split()

#: (rule, measure, comparison a clean document satisfies, threshold).
RULES = (
    ("mean word length", "word_chars / n_words", ">=", 2.0),
    ("mean word length", "word_chars / n_words", "<=", 15.0),
    ("symbols per word", "n_symbols / n_words", "<=", 0.3),
    ("stop words per word", "n_stop_words / n_words", ">=", 0.02),
    ("words with a letter", "n_letter_words / n_words", ">=", 0.6),
    ("repeated lines", "n_dup_lines / n_lines", "<=", 0.6),
    ("bullet lines", "n_bullet_lines / n_lines", "<=", 0.9),
    ("ellipsis lines", "n_ellipsis_lines / n_lines", "<=", 0.5),
)


def _counts(text: Column) -> list[Column]:
    t = F.coalesce(text, F.lit(""))
    return [t.alias("t"), F.regexp_extract_all(t, F.lit(WORD), F.lit(0)).alias("w"),
            F.filter(F.split(t, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("lines")]


#: The 3-word windows as text; a word holds no blank, so they differ as the words do.
_WINDOWS = """if(size(w) < 3, array(), transform(sequence(0, size(w) - 3),
              i -> concat_ws(' ', w[i], w[i + 1], w[i + 2])))"""
#: Places covered by windows that stand at two places: equal windows are
#: neighbours once windows are sorted with their places.
_REPEATED = """if(size(array_distinct(g)) = size(g), 0, transform(
    array(array_sort(transform(g, (x, i) -> named_struct('x', x, 'i', i)))),
    s -> size(array_distinct(flatten(zip_with(
        slice(s, 1, size(s) - 1), slice(s, 2, size(s) - 1),
        (a, b) -> if(a.x = b.x, array(a.i, a.i + 1, a.i + 2, b.i, b.i + 1, b.i + 2),
                     cast(array() as array<int>)))))))[0])"""


def _measured(docs: DataFrame, rules, min_words: int, max_repeat: int) -> DataFrame:
    """The columns of ``docs`` as jl_0, jl_1 and so on, and the counts and verdicts."""
    names = [f"jl_{i}" for i in range(len(docs.columns))]
    d = docs.select(*[docs[c].alias(n) for c, n in zip(docs.columns, names)], *_counts(docs["text"]))
    d = d.select(*names, "t", "w", "lines", F.expr(_WINDOWS).alias("g"))
    stop = F.filter("w", lambda x: F.lower(x).isin(STOP_WORDS))
    lettered = F.filter("w", lambda x: x.rlike(r"\p{L}"))
    bullet = F.filter("lines", lambda s: s.rlike(r"^\s*([-*•·]|[0-9]+[.)])\s"))
    dots = F.filter("lines", lambda s: s.rlike(r"(\.\.\.|…)\s*$"))
    counts = {
        "n_words": F.size("w"),
        "word_chars": F.length(F.translate("t", " \t\n\x0b\x0c\r", "")),
        "n_symbols": F.length("t") - F.length(F.translate("t", "#*$%&|<>", "")),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.expr(_REPEATED),
        "n_lines": F.size("lines"), "n_stop_words": F.size(stop),
        "n_letter_words": F.size(lettered), "n_bullet_lines": F.size(bullet),
        "n_ellipsis_lines": F.size(dots),
    }
    # one row from one: a later filter on the verdict stops here, else the planner
    # would push it down and repeat the counts, words and windows inside it
    once = F.explode(F.array(F.struct(*[c.cast("long").alias(k) for k, c in counts.items()])))
    d = d.select(*names, once.alias("counts")).select(*names, "counts.*")
    broken = []
    for rule, measure, sign, bound in rules:
        top, bottom = measure.split(" / ")
        broken.append(F.when(~F.expr(f"{top} {sign} {float(bound)}D * {bottom}"), F.lit(rule)))
    failed = F.array_compact(F.array(*broken)) if broken else F.expr("cast(array() as array<string>)")
    base = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat)
    return d.select("*", base.alias("base_failed"), failed.alias("failed_rules")) \
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def judge(docs: DataFrame, rules=RULES, min_words: int = MIN_WORDS,
          max_repeat: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    base_failed, kept (boolean) and ``failed_rules``, the table's rules broken."""
    own = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    return _measured(own, rules, min_words, max_repeat).select(
        F.col("jl_0").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "failed_rules")


def passing(docs: DataFrame, rules=RULES, min_words: int = MIN_WORDS,
            max_repeat: int = MAX_REPEAT_PERCENT) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    d = _measured(docs, rules, min_words, max_repeat).where("kept")
    return d.select(*[F.col(f"jl_{i}").alias(c) for i, c in enumerate(docs.columns)])
