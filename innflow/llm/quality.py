"""Quality rules by distribution divergence from language references.  Native: DataFrame functions only.

Base rules count, per text, words (cut at white space), their characters, marks of
``#*$%&|<>``, repeated lines and the words inside three-word windows that occur
twice or more.  A text fails them with under ``MIN_WORDS`` words or with
more than half of its words in repeated windows.

Every text adds, with equal weight, to the reference of its language: its words where it has ``MIN_WORDS`` or
more, its character classes where it passes the base rules.  A reference holds the shares of the classes and of
the ``COMMON_WORDS`` most frequent words (of a share of ``LEAST_SHARE`` at least), all others being one bin.  Each text that passes the base rules is then
compared with the reference of its language by the Jensen-Shannon distance (base 2,
0 to 1) of both histograms.

How far is too far is decided from all documents: within a language and a
doubling of the length (a short text strays further by chance), a distance above
q3 + 3 (q3 - q1) of the different distances is an outlier (equal texts count once, and
the quartile range counts as at least ``LEAST_RANGE``).  Guards: a histogram of fewer
than ``MIN_WORDS`` words or ``MIN_CHARS`` characters is not judged, nor is a
group of fewer than ``MIN_GROUP`` different distances; a language with fewer than
``MIN_REFERENCE`` texts of that length (or no language) is compared with the reference of all texts.

The text is read twice: once to count the words of the references, once to measure.  Neither
moves texts: a shuffle carries counts of words per language, summed before it.  The references of
the ``BROADCAST_LANGUAGES`` largest languages are broadcast (one row of at most
``COMMON_WORDS`` words each); further languages, each with a small share of
the rows by then, are joined by shuffle.

Words and windows are compared by 64-bit hashes within one text.

Defined results: null text is empty; empty and blank texts fail the base rules; a null
language is compared with the reference of all texts; rows with equal ids stay
separate; an empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innflow.llm.common import cut_lineage, text_or_empty

MIN_WORDS = 50
MIN_CHARS = 200
MIN_REFERENCE = 20
MIN_GROUP = 30
COMMON_WORDS = 100
LEAST_RANGE = 0.02
BROADCAST_LANGUAGES = 1_000
LEAST_SHARE = 1e-4

# Character classes after lower-case letters and white space, in order: a character belongs to the first that holds it, the rest are one more class.
CLASSES = [r"[A-Z]+", r"[0-9]+", r"""[.,;:!?'"()-]+""", r"[\p{L}\p{M}]+"]
_N_CLASSES = len(CLASSES) + 3
_ALL = "#all"
_UNIT = 1_000_000_000
_WORDS = r"split(_text, '[ \\t-\\r]+')"


def _held(df: DataFrame, keep: list[str], **columns: str) -> DataFrame:
    """``keep`` and new columns, computed once per row: no rule moves an expression across the generator."""
    fields = ", ".join(f"({e}) as {c}" for c, e in columns.items())
    return df.selectExpr(*keep, f"inline(array(struct({fields})))")


def _quoted(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def with_words(df: DataFrame) -> DataFrame:
    """``_text`` becomes ``_h`` (a 64-bit hash of each word), ``n_words``, ``_c`` (count of each character class) and the base counts that need no windows."""
    keep = [c for c in df.columns if c != "_text"]
    # letters and white space go first, so the other classes are cut from short remainders
    first = _held(df, [*keep, "_text"], _w=_WORDS, _r=r"regexp_replace(_text, '[a-z \\t-\\r]+', '')")
    rest = ["_r"]
    for pattern in CLASSES:
        rest.append(f"regexp_replace({rest[-1]}, '{_quoted(pattern)}', '')")
    sizes = ", ".join(f"char_length({r})" for r in rest)
    split = _held(first, [*keep, "_w"], _l=r"filter(split(_text, '\n'), l -> l rlike '[^ \\t-\\r]')", _n="char_length(_text)", _rest=f"array({sizes}, 0)",
                  word_chars="cast(char_length(array_join(_w, '')) as bigint)",
                  n_symbols="cast(char_length(regexp_replace(_r, '[^#*$%&|<>]+', '')) as bigint)")
    hashed = "transform(if(element_at(_w, 1) = '' or element_at(_w, -1) = '', filter(_w, x -> x <> ''), _w), x -> xxhash64(x))"
    return _held(split, [*keep, "word_chars", "n_symbols"], _h=hashed,
                 _c=f"""transform(concat(array(word_chars - _rest[0], _n - word_chars), transform(sequence(0, {len(CLASSES)}), k -> _rest[k] - _rest[k + 1])),
                        x -> cast(x as bigint))""",
                 n_dup_lines="cast(size(_l) - size(array_distinct(_l)) as bigint)").selectExpr("*", "cast(size(_h) as bigint) as n_words")


def with_base_rules(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words`` and ``base_failed`` to the columns of ``with_words``."""
    keep = df.columns
    windows = _held(df, keep, _v="""if(size(_h) < 3, cast(array() as array<bigint>),
        transform(sequence(1, size(_h) - 2), i -> xxhash64(element_at(_h, i), element_at(_h, i + 1), element_at(_h, i + 2))))""")
    ordered = _held(windows, keep, _s="if(size(_v) = size(array_distinct(_v)), null, sort_array(transform(_v, (v, i) -> struct(v, i))))")
    # windows that equal a neighbour in hash order, in text order again
    found = _held(ordered, keep, _p="""if(_s is null, null, sort_array(filter(transform(sequence(1, size(_s)), j -> if(
        (j > 1 and element_at(_s, greatest(j - 1, 1)).v = element_at(_s, j).v)
        or (j < size(_s) and element_at(_s, least(j + 1, size(_s))).v = element_at(_s, j).v), element_at(_s, j).i, null)), x -> x is not null)))""")
    covered = """cast(coalesce(aggregate(_p, named_struct('last', -3, 'n', 0),
                 (a, p) -> named_struct('last', p, 'n', a.n + least(3, p - a.last)), a -> a.n), 0) as bigint)"""
    return _held(found, keep, n_repeat_words=covered).withColumn(
        "base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words"))


def _shares(counts: str) -> str:
    return f"transform({counts}, x -> x / greatest(aggregate({counts}, 0L, (a, y) -> a + y), 1L))"


def word_references(read: DataFrame) -> DataFrame:
    """One row per language and one of all (``_ref``): ``_texts``, ``_word_h`` (hashes of the common words), ``_word_q`` (shares, first of
    all others), ``_word_bits`` (4,096 bits, set where a common word's hash ends so).

    ``read`` has ``_lang`` and ``_text``.  Every text of ``MIN_WORDS`` words or more weighs the same, so a few long ones
    cannot bend a reference.
    """
    split = _held(read, ["_lang"], _w=_WORDS).selectExpr(
        "_lang as _ref", "_w", "size(_w) - if(element_at(_w, 1) = '', 1, 0) - if(size(_w) > 1 and element_at(_w, -1) = '', 1, 0) as n").where(f"n >= {MIN_WORDS}")
    words = (split.selectExpr("_ref", f"cast({_UNIT}D / n as bigint) as share", "explode(_w) as term").where("term <> ''")
             .groupBy("_ref", F.xxhash64("term").alias("h")).agg(F.sum("share").alias("n")))
    words = cut_lineage(words, "quality-words")
    texts = read.groupBy(F.col("_lang").alias("_total_ref")).agg(F.count(F.lit(1)).alias("_texts"))
    totals = texts.join(words.groupBy(F.col("_ref").alias("_r")).agg(F.sum("n").alias("total")), F.col("_total_ref").eqNullSafe(F.col("_r"))).drop("_r")
    totals = cut_lineage(totals, "quality-totals")
    frequent = cut_lineage(words.join(totals, F.col("_ref").eqNullSafe(F.col("_total_ref"))).where(f"n >= {LEAST_SHARE} * total")
                           .select("_ref", "h", "n"), "quality-frequent")
    named = totals.where(f"_total_ref is not null and _texts >= {MIN_REFERENCE}").unionByName(
        totals.agg(F.lit(_ALL).alias("_total_ref"), F.sum("_texts").alias("_texts"), F.sum("total").alias("total")).where("total > 0"))
    every = frequent.where(F.col("_ref").isNotNull()).unionByName(
        frequent.groupBy("h").agg(F.sum("n").alias("n")).select(F.lit(_ALL).alias("_ref"), "h", "n"))
    top = every.selectExpr("*", "row_number() over (partition by _ref order by n desc, h) as id").where(f"id <= {COMMON_WORDS}")
    listed = top.groupBy("_ref").agg(F.expr("array_sort(collect_list(struct(id, h, n)))").alias("common"))
    bits = """transform(sequence(0, 63), s -> aggregate(filter(_word_h, h -> (h & 63) = s), 0L,
              (a, h) -> a | shiftleft(1L, cast(shiftright(h, 6) & 63 as int)))) as _word_bits"""
    return listed.join(named, F.col("_ref") == F.col("_total_ref")).selectExpr(
        "_ref", "_texts", "transform(common, x -> x.h) as _word_h",
        "concat(array((total - aggregate(common, 0L, (a, x) -> a + x.n)) / total), transform(common, x -> x.n / total)) as _word_q"
    ).selectExpr("*", bits)


def class_references(measured: DataFrame) -> DataFrame:
    """``_class_ref`` and ``_class_q``: the mean shares of the character classes over the texts that pass the base rules, per language and of all."""
    weighed = measured.where(f"not base_failed and n_chars >= {MIN_CHARS}").groupBy(F.col("_lang").alias("_class_ref")).agg(
        F.array(*[F.sum(F.floor(F.col("_c")[k] * F.lit(float(_UNIT)) / F.col("n_chars"))) for k in range(_N_CLASSES)]).alias("c"))
    weighed = cut_lineage(weighed, "quality-classes")
    whole = weighed.agg(F.lit(_ALL).alias("_class_ref"), F.array(*[F.sum(F.col("c")[k]) for k in range(_N_CLASSES)]).alias("c"))
    return weighed.where(F.col("_class_ref").isNotNull()).unionByName(whole).selectExpr("_class_ref", f"{_shares('c')} as _class_q")


def _js_part(p: str, q: str) -> str:
    """A bin's part of twice the Jensen-Shannon divergence in bits."""
    return f"(if({p} > 0, {p} * log2(2 * {p} / ({p} + {q})), 0D) + if({q} > 0, {q} * log2(2 * {q} / ({p} + {q})), 0D))"


def with_word_distance(df: DataFrame) -> DataFrame:
    """Adds ``word_distance`` (null where the guards forbid) in place of the words and their reference."""
    drop = ("_h", "_word_h", "_word_q", "_word_bits")
    keep = [c for c in df.columns if c not in drop]
    # a bit of 4,096 tells most words that are not common before the list is searched; frequent words come first there
    common = "bit_get(element_at(_word_bits, cast(x & 63 as int) + 1), cast(shiftright(x, 6) & 63 as int)) = 1"
    numbers = f"""if(_word_h is not null and not base_failed and n_words >= {MIN_WORDS},
        sort_array(filter(transform(filter(_h, x -> {common}), x -> array_position(_word_h, x)), x -> x > 0)), null)"""
    held = _held(df, [*keep, "_word_q"], _ids=numbers)
    # equal numbers are runs of the sorted list: a run that ends adds its part and the share of the reference it has met;
    # a common word that the text lacks adds its whole share
    ends = _js_part("(a.run / n_words)", "element_at(_word_q, cast(a.id + 1 as int))")
    other = _js_part("((n_words - size(_ids)) / n_words)", "element_at(_word_q, 1)")
    words = f"""if(_ids is null, null, sqrt(greatest(0D, {other} / 2 + if(size(_ids) = 0, (1 - element_at(_word_q, 1)) / 2,
        aggregate(concat(_ids, array(-1L)), named_struct('id', try_element_at(_ids, 1), 'run', 0, 'js', 0D, 'met', element_at(_word_q, 1)),
        (a, x) -> if(x = a.id, named_struct('id', a.id, 'run', a.run + 1, 'js', a.js, 'met', a.met),
                     named_struct('id', x, 'run', 1, 'js', a.js + {ends}, 'met', a.met + element_at(_word_q, cast(a.id + 1 as int)))),
        a -> (a.js + 1 - a.met) / 2)))))"""
    return _held(held, keep, word_distance=words)


def with_char_distance(df: DataFrame) -> DataFrame:
    """Adds ``char_distance`` (null where the guards forbid) from ``_c`` and ``_class_q``."""
    return df.withColumn("char_distance", F.expr(f"""if(_class_q is not null and not base_failed and n_chars >= {MIN_CHARS}, sqrt(greatest(0D, aggregate(
        zip_with(_c, _class_q, (c, q) -> named_struct('p', c / n_chars, 'q', q)), 0D, (a, x) -> a + {_js_part('x.p', 'x.q')}) / 2)), null)"""))


def _with_reference(docs: DataFrame, refs: DataFrame) -> DataFrame:
    """``docs`` with the reference of their language in ``_ref`` (that of all texts where it has none)."""
    largest = F.broadcast(refs.where(F.col("_ref") != _ALL).orderBy(F.col("_texts").desc(), "_ref").limit(BROADCAST_LANGUAGES))
    own = docs.join(largest, docs["_lang"] == largest["_ref"], "left")
    many = refs.count() > BROADCAST_LANGUAGES + 1
    if many:  # further languages: each is a small share of the rows, and Spark may split it
        rest = refs.where(F.col("_ref") != _ALL).join(largest.select(F.col("_ref").alias("_l")), F.col("_ref") == F.col("_l"), "left_anti")
        rest = rest.select(*[F.col(c).alias(f"{c}_2") for c in rest.columns])
        own = own.join(rest, F.col("_ref").isNull() & (F.col("_lang") == F.col("_ref_2")), "left")
        own = own.select(*docs.columns, *[F.coalesce(c, f"{c}_2").alias(c) for c in refs.columns])
    whole = F.broadcast(refs.where(F.col("_ref") == _ALL).select(*[F.col(c).alias(f"{c}_3") for c in refs.columns]))  # one row or none
    every = own.join(whole, F.col("_ref").isNull(), "left")
    return every.select(*docs.columns, *[F.coalesce(c, f"{c}_3").alias(c) for c in refs.columns if c != "_texts"])


def quality_report(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per row: id, base counts, ``base_failed``, ``kept``, ``char_distance``, ``word_distance`` and their fences."""
    read = docs.select(F.col(id_col).alias("_id"), F.col(lang).cast("string").alias("_lang"), text_or_empty(text).alias("_text"))
    refs = cut_lineage(word_references(read.select("_lang", "_text")), "quality-references")
    based = with_base_rules(with_words(read).withColumn("n_chars", F.expr("aggregate(_c, 0L, (a, x) -> a + x)")))
    # narrow rows from here on: the classes are compared once all texts have added to their reference
    narrow = cut_lineage(with_word_distance(_with_reference(based, refs)), "quality-words-measured")
    classes = cut_lineage(class_references(narrow), "quality-class-references")
    if refs.count() <= BROADCAST_LANGUAGES + 1:
        classes = F.broadcast(classes)
    measured = with_char_distance(narrow.join(classes, F.col("_ref") == F.col("_class_ref"), "left")).drop("_c", "_class_ref", "_class_q").withColumn(
        "_length", F.floor(F.log2(F.greatest("n_words", F.lit(1)))))
    measured = cut_lineage(measured, "quality-distances")
    fences = None
    for c in ("char_distance", "word_distance"):
        different = measured.where(F.col(c).isNotNull()).select("_ref", "_length", c).distinct()
        # a length with too few texts of its own takes the fence of all lengths (length null)
        lengths = different.withColumn("_length", F.explode(F.array("_length", F.lit(None).cast("bigint"))))
        quartiles = lengths.groupBy("_ref", "_length").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(c, [0.25, 0.75], 10_000).alias("q"))
        fence = quartiles.selectExpr("_ref as _f_ref", "coalesce(_length, -1) as _f_length",
                                     f"if(n >= {MIN_GROUP}, q[1] + 3 * greatest(q[1] - q[0], {LEAST_RANGE}D), null) as {c.split('_')[0]}_fence")
        fences = fence if fences is None else fences.join(fence, ["_f_ref", "_f_length"], "full")
    fences = cut_lineage(fences, "quality-fences")
    any_length = fences.where("_f_length = -1").selectExpr("_f_ref as _a_ref", "char_fence as _a_char", "word_fence as _a_word")
    judged = measured.join(fences, (F.col("_ref") == F.col("_f_ref")) & (F.col("_length") == F.col("_f_length")), "left").join(
        any_length, F.col("_ref") == F.col("_a_ref"), "left")
    judged = judged.withColumn("char_fence", F.coalesce("char_fence", "_a_char")).withColumn("word_fence", F.coalesce("word_fence", "_a_word"))
    fits = "coalesce(char_distance <= char_fence, true) and coalesce(word_distance <= word_fence, true)"
    return judged.selectExpr("_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                             f"not base_failed and {fits} as kept", "char_distance", "word_distance", "char_fence", "word_fence"
                             ).withColumnRenamed("_id", id_col)

