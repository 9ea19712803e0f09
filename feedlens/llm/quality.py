"""Quality rules: divergence of a document from its language.

Two histograms of a document are compared with the reference of its language
by the Jensen-Shannon distance: character classes, and the most common words
of the language.  A language's reference is the mean histogram of labelled good
documents (``labelled_references``: a bounded sample), so that a verdict does not
depend on the other documents that are judged.  Without labels the corpus gives
its own references: the mean of all documents of the language that are long
enough, taken a second time without those far from the first mean.  DataFrame
operations only; everything a document needs is computed in its own row, so no
text and no word is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, let, save

#: Common words by language (the references' word bins).
COMMON = {
    "en": ("the", "of", "and", "to", "in", "that", "is", "was", "it", "for", "on", "are"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "ist", "des", "auf"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "que", "est", "dans", "pour"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por"),
}
N_COMMON = 12
CLASSES = ("lower", "upper", "space", "digit", "mark", "symbol", "other")

#: Largest distances a document may have, between those of the good and of the
#: bad labelled documents: of the characters alone, and of both histograms
#: together (root mean square).
MAX_CLASS_DISTANCE = 0.25
MAX_JOINT_DISTANCE = 0.19
#: The same below LONG_WORDS words, where histograms scatter more.
MAX_SHORT_JOINT_DISTANCE = 0.24
LONG_WORDS = 100
#: Guards: shorter documents are not judged; from 50 words, where the base
#: rule ends, the characters are judged whatever their number.
MIN_CHARS = 300
MIN_WORDS = 50
#: Documents farther than this from the first reference don't count in the second.
TRIM_DISTANCE = 0.3
#: Labelled good documents that references are made of: the first by a hash of
#: the id.
LABELLED = 6000


def _repeat_words(words: Column) -> Column:
    """Words covered by a 3-word window that the text holds twice or more.

    Windows are hashed and sorted with their positions: equal ones are
    neighbours, so the work is n log n also for very long texts."""
    def covered(h):
        def places(s):
            at = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                          lambda i: (s[i]["h"] == F.get(s, i - 1)["h"]) | (s[i]["h"] == F.get(s, i + 1)["h"]))
            return F.size(F.array_distinct(F.flatten(F.transform(
                at, lambda i: F.array(s[i]["i"], s[i]["i"] + 1, s[i]["i"] + 2)))))
        with_place = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(with_place, places))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                          lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))
    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(windows, covered))


def _rest(text: str, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def measures(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Counts and the two histograms of each document (arrays of counts)."""
    df = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # each step removes one class of characters from what the steps before left
    df = (df.withColumn("r1", _rest("text", r"\p{Ll}+")).withColumn("r2", _rest("r1", r"[\x20\x09-\x0D]+"))
          .withColumn("r3", _rest("r2", r"\p{Lu}+")).withColumn("r4", _rest("r3", r"\p{Nd}+"))
          .withColumn("r5", _rest("r4", r"""[.,;:!?'"()-]+""")).withColumn("r6", _rest("r5", r"[\x21-\x7E]+")))
    n = [F.length(c) for c in ("text", "r1", "r2", "r3", "r4", "r5", "r6")]
    classes = F.array(*[a - b for a, b in zip(n, n[1:])], n[-1])
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.regexp_like(x, F.lit(WORD)))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    common = F.lit(None).cast("array<string>")
    for lang, listed in COMMON.items():
        common = F.when(F.col("lang") == lang, F.array(*map(F.lit, listed))).otherwise(common)
    df = df.select(
        "id", "lang", n[0].cast("long").alias("n_chars"), classes.alias("classes"),
        (n[0] - (F.length("r1") - F.length("r2"))).cast("long").alias("word_chars"),
        (F.length("r4") - F.length(F.translate("r4", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        words.alias("words"), common.alias("common"))
    df = df.withColumn("places", let(F.col("common"), lambda c: F.transform(
        "words", lambda w: F.coalesce(F.array_position(c, w), F.lit(0).cast("long")))))
    hist = [F.size("places") - F.size(F.array_remove("places", F.lit(j).cast("long"))) for j in range(1, N_COMMON + 1)]
    return df.select(
        "id", "lang", "n_chars", "classes", "word_chars", "n_symbols", "n_dup_lines",
        F.size("words").cast("long").alias("n_words"), _repeat_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.array(*hist, F.size("places") - F.size(F.array_remove("places", F.lit(0).cast("long")))).alias("commons"),
        F.col("common").isNotNull().alias("listed"))


def _shares(counts: Column) -> Column:
    return let(F.aggregate(counts, F.lit(0.0), lambda a, x: a + x),
               lambda t: F.transform(counts, lambda x: F.when(t > 0, x / t).otherwise(F.lit(0.0))))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two arrays of shares."""
    def part(a, b):
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))
    total = F.aggregate(F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a)), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def _references(measured: DataFrame, by: Column | None = None) -> DataFrame:
    """Mean histograms by language (one row each), or by ``by``."""
    by = F.col("lang") if by is None else by
    mean = lambda c, n: F.array(*[F.round(F.avg(F.get(F.col(c), F.lit(i))), 9) for i in range(n)])
    return (measured.groupBy(by.alias("ref_lang"))
            .agg(mean("class_shares", len(CLASSES)).alias("class_ref"), mean("word_shares", N_COMMON + 1).alias("word_ref")))


def _with_shares(m: DataFrame) -> DataFrame:
    return m.withColumns({"class_shares": _shares(F.col("classes")), "word_shares": _shares(F.col("commons"))})


def _long_enough(m: DataFrame) -> DataFrame:
    return m.filter((F.col("n_chars") >= MIN_CHARS) & (F.col("n_words") >= LONG_WORDS))


def labelled_references(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        lang_col: str = "lang", label_col: str = "quality", *, limit: int = LABELLED) -> DataFrame:
    """``ref_lang, class_ref, word_ref`` of the documents that ``labels``
    (``id_col``, ``label_col``) call good (1), at most ``limit`` of them, and one
    row with ``anything`` true over all of them, for languages without a row.
    Contradicting labels of one id are left out."""
    known = (labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("good_id"))
             .agg(F.min(label_col).alias("least")).filter("least = 1").select("good_id"))
    order = lambda c: (F.xxhash64(F.col(c).cast("string")), F.col(c))
    good = known.orderBy(*order("good_id")).limit(limit)         # bounded, so it is broadcast
    rows = (docs.select(id_col, text_col, lang_col).join(F.broadcast(good), F.col(id_col) == F.col("good_id"))
            .orderBy(*order("good_id"), text_col).limit(limit))
    m = save(_with_shares(_long_enough(measures(rows, id_col, text_col, lang_col))), "labelled")
    every = _references(m, F.lit(None).cast("string")).withColumn("anything", F.lit(True))
    return save(_references(m).withColumn("anything", F.lit(False)).unionByName(every), "references")


def _joined(measured: DataFrame, refs: DataFrame) -> DataFrame:
    """``measured`` with its language's reference; without one, with that over
    all languages, if there is any.  One row a language: small."""
    own = refs.filter(~F.col("anything")).drop("anything")
    every = refs.filter("anything").agg(F.max(F.struct("class_ref", "word_ref"))).scalar()
    j = measured.join(own, measured["lang"].eqNullSafe(own["ref_lang"]), "left")
    return j.withColumn("own_reference", F.col("class_ref").isNotNull()).withColumns(
        {c: F.coalesce(c, every[c]) for c in ("class_ref", "word_ref")})


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *,
          references: DataFrame | None = None, max_class: float = MAX_CLASS_DISTANCE, max_joint: float = MAX_JOINT_DISTANCE,
          max_short_joint: float = MAX_SHORT_JOINT_DISTANCE) -> DataFrame:
    """One row per input row: ``id``, ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``class_distance``, ``word_distance`` (NULL where a guard holds), ``kept``.

    ``references`` are those of ``labelled_references``; without them the corpus
    gives its own, also from a single document.  NULL and empty texts have zero
    counts and fail the base rule.  A NULL or unlisted language is judged by
    its characters only; a language without a reference by its characters
    against the reference over all languages.  A NULL id stays NULL; repeated rows are judged
    each; texts are read whole; other columns are not read; an empty table
    gives no rows.
    """
    m = _with_shares(save(measures(docs, id_col, text_col, lang_col), "measures"))
    if references is None:
        fit = _long_enough(m)
        first = save(_references(fit).withColumn("anything", F.lit(False)), "references")
        # once more without the documents that are far from the first reference
        near = _joined(fit, first).filter((js_distance(F.col("class_shares"), F.col("class_ref")) <= TRIM_DISTANCE)
                                          & (js_distance(F.col("word_shares"), F.col("word_ref")) <= TRIM_DISTANCE))
        references = save(_references(near).withColumn("anything", F.lit(False)), "references")
    out = _joined(m, references)
    out = out.withColumns({
        "class_distance": F.when(((F.col("n_chars") >= MIN_CHARS) | (F.col("n_words") >= MIN_WORDS)) & F.col("class_ref").isNotNull(),
                                 js_distance(F.col("class_shares"), F.col("class_ref"))),
        "word_distance": F.when((F.col("n_words") >= MIN_WORDS) & F.col("listed") & F.col("own_reference"),
                                js_distance(F.col("word_shares"), F.col("word_ref"))),
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))})
    joint = F.sqrt((F.pow("class_distance", F.lit(2)) + F.pow("word_distance", F.lit(2))) / 2)
    limit = F.when(F.col("n_words") < LONG_WORDS, F.lit(max_short_joint)).otherwise(F.lit(max_joint))
    far = F.coalesce(F.col("class_distance") > max_class, F.lit(False)) | F.coalesce(joint > limit, F.lit(False))
    return out.select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "class_distance", "word_distance", (~F.col("base_failed") & ~far).alias("kept"))
