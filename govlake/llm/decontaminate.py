"""Benchmark items in documents, also re-parameterised ones, in DataFrame expressions only.

Numbers, units and names are replaced by typed placeholders, which leaves a template. Windows of
template words of the benchmark are hash-joined with those of the documents. Matches on one
diagonal (document position less item position) and on neighbouring ones are one occurrence; there
every value of the item has to stand for one value of the document, or the likeness is chance.
An item with very many capitals, as in languages that capitalise every noun, is read with names as
words. A further set of windows holds the literal words in lower case, so
a verbatim copy is found whatever its case, its place and its slots.

Few documents hold anything of a benchmark, and telling slots apart is the dear part. So texts are first
split plainly into words, and the pairs of words in a row that the benchmark has are counted over all
documents. A text with a window of the benchmark must have all pairs of plain words in it, so also
the rarest one; texts without any window's rarest pair are let go. This is a necessary condition of
a match, nothing is lost by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, text_of, unused

WINDOW = 8
#: A window with fewer words that are no placeholders proves nothing, nor does an item without one.
LITERALS = 4
#: Share of an item's words that has to be covered.
COVERED = 0.5
#: A match of so many words in a row counts whatever its share of the item.
PASSAGE = 15
#: Diagonals of one item at most so far apart are neighbours: words put in or left out between them.
SLACK = 3
#: A literal item of fewer than LITERALS words needs as many letters and digits to prove anything.
LEAST_CHARS = 12
#: Share of an item's words above which capitals are taken for spelling, not for names.
CAPITALS = 0.25
#: Words of a text that are cut into windows together.
PIECE = 1024
#: Word pairs that texts are tested for; a benchmark with more is matched against every text.
PAIRS = 20_000
#: Benchmark windows that may be broadcast, at 150 bytes or so; beyond it the join shuffles.
BROADCAST_WINDOWS = 200_000

#: Marks in front of slots, from the private use area.
NUMBER, UNIT, NAME = "\ue000", "\ue001", "\ue002"
UNITS = ("percent mm cm m km in ft yd mi mg g kg lb lbs oz t ml cl l gal s sec min h hr hrs ms kb mb gb tb "
         "meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters inch inches "
         "foot feet yard yards mile miles gram grams kilogram kilograms pound pounds ounce ounces ton tons liter "
         "liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month "
         "months year years dollar dollars cent cents euro euros degree degrees mph kmh kph").split()


_UNSPACED = "".join(rf"\p{{Is{s}}}" for s in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar"))

#: Ranges that hold these scripts, which are quicker to test; letters in them are in no plain word.
_WIDE = (r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u19E0-\u19FF\u2E80-\u9FFF\uA9E0-\uA9FF\uAA60-\uAA7F"
         r"\uF900-\uFAFF\uFF66-\uFF9F\x{10000}-\x{3FFFF}")


def marked(text: Column, names: bool = True) -> Column:
    """The words of a text; those that are slots carry the mark of their type in front.

    A number may have inner points, commas and colons; a unit follows a number or is a sign before
    or after it; a name is a capitalised word inside a sentence, unless `names` is off. Numbers in a
    row are one slot, and so are names."""
    # possessive, and never from within a longer number: linear on long lists of numbers
    number = r"(?<![0-9])(?<![0-9][.,:])[0-9]++(?:[.,:][0-9]++)*+"
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    text = F.regexp_replace(text, r"([$€£¥])\s*(?=[0-9])", f" {UNIT}$1 ")
    text = F.regexp_replace(text, rf"({number})\s*([%€$£¥°]|(?i:{units})(?![\p{{L}}\p{{N}}]))", f" {NUMBER}$1 {UNIT}$2 ")
    text = F.regexp_replace(text, rf"(?<![\p{{L}}\p{{N}}{NUMBER}])({number})(?![\p{{L}}\p{{N}}])", f" {NUMBER}$1 ")
    if names:
        text = F.regexp_replace(text, r"(?<=[\p{L}\p{N},;)] )(\p{Lu}\p{Ll}+)(?![\p{L}\p{N}])", f"{NAME}$1")
    # possessive repeats, which Java runs without recursion
    one, name = rf"{NUMBER}[0-9]++(?:[.,:][0-9]++)*+", rf"{NAME}[\p{{L}}\p{{M}}\p{{N}}]++"
    return F.regexp_extract_all(
        text, F.lit(rf"{one}(?:\s++{one})*+|{name}(?:\s++{name})*+|{UNIT}?[$€£¥%°]|{UNIT}?[\p{{L}}\p{{M}}\p{{N}}]+"),
        F.lit(0))


def literal(text: Column) -> Column:
    """The words of a text in lower case: numbers, signs of arithmetic between or after digits, and
    single characters of scripts without spaces."""
    return F.regexp_extract_all(F.lower(text), F.lit(
        r"[0-9]++(?:[.,:][0-9]++)*+|(?<=[0-9)] ?)[-+*/=^<>×÷−]"
        rf"|[{_UNSPACED}]\p{{M}}*+|[\p{{L}}\p{{M}}\p{{N}}&&[^0-9{_UNSPACED}]]++"), F.lit(0))


#: How texts are read: templates, templates whose names are words, and literally.
TEMPLATE, NAMELESS, SPOKEN = "template", "nameless", "spoken"


def _words(text: Column, how: str) -> Column:
    return literal(text) if how == SPOKEN else marked(text, how == TEMPLATE)


def _is_slot(word: Column) -> Column:
    return F.substring(word, 1, 1).isin(NUMBER, UNIT, NAME)


def _windows(df: DataFrame, sizes: list[int], keep: list[str], how: str) -> DataFrame:
    """`keep` columns with a row per window of each size: size, at (from 1), window (hash), words.

    A text is cut into pieces of PIECE words that overlap by a window, so no row holds more windows
    than a piece has, however long the text.
    """
    most = max(sizes)
    df = df.withColumn("__words", _words(F.col("text"), how))
    starts = F.sequence(F.lit(0), F.greatest(F.size("__words") - 1, F.lit(0)), F.lit(PIECE))
    pieces = df.select(*keep, F.explode(F.transform(starts, lambda s: F.struct(
        s.alias("from"), F.slice("__words", s + 1, PIECE + most - 1).alias("words")))).alias("p")).select(*keep, "p.*")
    # a slot's hash is that of its type
    pieces = pieces.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(
        F.when(_is_slot(w), F.substring(w, 1, 1)).otherwise(F.lower(w)))))

    def of_size(n: int) -> Column:
        last = F.least(F.size("hashes") - (n - 1), F.lit(PIECE))
        places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.struct(
            F.lit(n).alias("size"), (F.col("from") + i).alias("at"), F.xxhash64(F.slice("hashes", i, n)).alias("window"),
            F.slice("words", i, n).alias("words")))

    parts = [of_size(n) for n in sizes]
    found = parts[0] if len(parts) == 1 else F.concat(*parts)
    return pieces.select(*keep, F.explode(found).alias("w")).select(*keep, "w.*")


def _slots(words: str | Column) -> Column:
    """The slots of a window in lower case, null where a word is none."""
    return F.transform(words, lambda w: F.when(_is_slot(w), F.lower(w)))


def _wanted(items: DataFrame, how: str) -> DataFrame:
    """Windows of the items, each of its own size: item_id, length (words of the item), size, item_at, window,
    item_words. Template windows of fewer than LITERALS words that are no slots, and literal items that
    prove nothing, have none."""
    read = items.withColumn("__words", _words(F.col("text"), how)).withColumn("length", F.size("__words"))
    if how == SPOKEN:
        read = read.where((F.col("length") >= LITERALS) | (F.length(F.array_join("__words", "")) >= LEAST_CHARS))
    else:
        read = read.where(f"length >= {LITERALS}")
    if how != SPOKEN:
        with_names = marked(F.col("text"))
        named = F.size(F.filter(with_names, lambda w: F.substring(w, 1, 1) == NAME)) > F.size(with_names) * CAPITALS
        read = read.where(~named if how == TEMPLATE else named)
    read = read.select("item_id", "text", "length")
    found = (_windows(read, _sizes(read), ["item_id", "length"], how).where(f"size = least(length, {WINDOW})")
             .select("item_id", "length", "size", F.col("at").alias("item_at"), "window", F.col("words").alias("item_words")))
    if how != SPOKEN:
        found = found.where(F.size(F.filter("item_words", lambda w: ~_is_slot(w))) >= LITERALS)
    return cut(found)


def _pairs(words: str) -> Column:
    """Hashes of the pairs of plain words in a row in a window. Words with digits, slots and words of scripts
    without spaces are not plain: a plain split would cut them elsewhere."""
    made = F.transform(words, lambda w: F.when(w.rlike(rf"^[\p{{L}}\p{{M}}&&[^{_WIDE}]]+$"), F.lower(w)))
    both = F.zip_with(made, F.slice(made, 2, F.size(words)), lambda a, b: F.when(
        a.isNotNull() & b.isNotNull(), F.xxhash64(a, b)))
    return F.filter(both, lambda p: p.isNotNull())


def _among(name: str, values: list[int]) -> str:
    """SQL for whether a number is one of many; a set in the plan, as parsing beats making literals."""
    return f"{name} IN ({', '.join(f'{v}L' for v in values)})" if values else "false"


def _may_hold(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """The rows that have the rarest pair of some window, or may have one of the windows without pairs.
    A benchmark of more than PAIRS pairs lets all rows pass. The pairs and their counts are all that is
    gathered."""
    paired = windows.select("window", _pairs("item_words").alias("pairs"), "item_words")
    asked = [r.p for r in paired.select(F.explode("pairs").alias("p")).distinct().limit(PAIRS + 1).collect()]
    if len(asked) > PAIRS:
        return rows
    # a window without a pair: its longest word, as it may stand within a longer one
    alone = paired.where(F.size("pairs") == 0).select(F.transform(F.filter(
        "item_words", lambda w: ~_is_slot(w)), lambda w: F.struct(F.length(w).alias("n"), F.lower(w).alias("w"))).alias("w"))
    words = [r.w for r in alone.select(F.array_max("w")["w"].alias("w")).where("w is not null").distinct().limit(51).collect()]
    other = F.lit(False)
    for w in words[:50]:
        other = other | F.lower("text").contains(w)
    other = F.lit(True) if len(words) > 50 else other
    # columns of their own and a generator, so that neither a step nor the filter does another one again
    pairs = "zip_with(__tokens, slice(__tokens, 2, size(__tokens)), (a, b) -> xxhash64(a, b))"
    split = (rows.withColumn("__tokens", F.split(F.lower("text"), rf"[[^\p{{L}}\p{{M}}]{_WIDE}]++"))
             .withColumn("__every", F.expr(pairs)).drop("__tokens").withColumn("__other", other))
    found = F.array_distinct(F.expr(f"filter(__every, p -> {_among('p', asked)})"))
    some = (split.select(*rows.columns, "__other", F.explode(F.array(found)).alias("__pairs"))
            .where((F.size("__pairs") > 0) | F.col("__other")))
    some = cut(some)
    often = dict(some.select(F.explode("__pairs").alias("p")).groupBy("p").count().collect())
    spark = rows.sparkSession
    table = spark.createDataFrame([(p, often.get(p, 0)) for p in asked], "p long, n long")
    rarest = (paired.select("window", F.explode("pairs").alias("p")).join(F.broadcast(table), "p")
              .groupBy("window").agg(F.min(F.struct("n", "p")).alias("least")).where("least.n > 0").select("least.p").distinct())
    keys = [r.p for r in rarest.collect()]
    return some.where(F.expr(f"exists(__pairs, p -> {_among('p', keys)})") | F.col("__other")).drop("__pairs", "__other")


def _sizes(items: DataFrame) -> list[int]:
    found = items.select(F.least("length", F.lit(WINDOW)).alias("size")).distinct().collect()
    return sorted(r.size for r in found) or [WINDOW]  # an empty benchmark matches nothing


def _met(rows: DataFrame, wanted: DataFrame, how: str) -> DataFrame:
    """Windows of texts beside the item windows that they equal."""
    sizes = [r["size"] for r in wanted.select("size").distinct().collect()] or [WINDOW]
    side = F.broadcast(wanted) if wanted.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS else wanted
    return _windows(rows, sorted(sizes), ["doc_id", "text_key"], how).join(side, ["size", "window"])


def _cover() -> Column:
    """The words of the item that its matching places (item_at, size) cover, in order."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(
        "places", lambda p: F.sequence(p["item_at"], p["item_at"] + p["size"] - 1)))))


def _run() -> Column:
    """The most words in a row of those covered."""
    now = lambda s, at: F.when(at == s["last"] + 1, s["now"] + 1).otherwise(1)
    start = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("now"), F.lit(0).alias("most"))
    return F.aggregate("cover", start, lambda s, at: F.struct(
        at.cast("int").alias("last"), now(s, at).alias("now"), F.greatest(s["most"], now(s, at)).alias("most")),
        lambda s: s["most"])


def _template(rows: DataFrame, wanted: DataFrame, how: str, covered: float) -> DataFrame:
    """Occurrences of item templates."""
    key = ["doc_id", "text_key", "item_id", "length"]
    met = _met(rows, wanted, how)
    pairs = F.filter(F.zip_with(_slots("item_words"), _slots("words"), lambda i, d: F.when(
        i.isNotNull(), F.struct(i.alias("item"), d.alias("doc")))), lambda p: p.isNotNull())
    each = (met.groupBy(*key, (F.col("at") - F.col("item_at")).alias("diagonal"))
            .agg(F.collect_set(F.struct("item_at", "size")).alias("places"),
                 F.array_distinct(F.flatten(F.collect_set(pairs))).alias("values")))
    # diagonals with none over SLACK between them are one chain
    order = Window.partitionBy(*key).orderBy("diagonal")
    before = F.lag("diagonal").over(order)
    chained = (each.withColumn("first", F.when(F.col("diagonal") - before <= SLACK, 0).otherwise(1))
               .withColumn("chain", F.sum("first").over(order)))
    joined = (chained.groupBy(*key, "chain")
              .agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
                   F.array_distinct(F.flatten(F.collect_list("values"))).alias("values"),
                   F.collect_list(F.struct("places", "values")).alias("alone")))
    # a diagonal also stands alone, where a chain has values that do not fit together
    both = joined.select(*key, F.explode(F.when(F.size("alone") == 1, F.col("alone")).otherwise(
        F.concat(F.array(F.struct("places", "values")), "alone"))).alias("o")).select(*key, "o.*")
    return (both.where(F.size("values") == F.size(F.array_distinct(F.transform("values", lambda p: p["item"]))))
            .withColumn("cover", _cover())
            .withColumn("coverage", F.size("cover") / F.col("length"))
            .where((F.col("coverage") >= covered) | (_run() >= PASSAGE))
            .select("doc_id", "text_key", "item_id", F.size("places").alias("windows"), "coverage",
                    F.forall("values", lambda p: p["item"] == p["doc"]).alias("same_values")))


def _verbatim(rows: DataFrame, wanted: DataFrame, covered: float) -> DataFrame:
    """Occurrences of literal passages without a gap: a share of the item, or PASSAGE words."""
    key = ["doc_id", "text_key", "item_id", "length"]
    each = (_met(rows, wanted, SPOKEN).groupBy(*key, (F.col("at") - F.col("item_at")).alias("diagonal"))
            .agg(F.collect_set(F.struct("item_at", "size")).alias("places")))
    return (each.withColumn("cover", _cover()).withColumn("run", _run())
            .where((F.col("run") >= F.col("length") * covered) | (F.col("run") >= PASSAGE))
            .select("doc_id", "text_key", "item_id", F.size("places").alias("windows"),
                    (F.size("cover") / F.col("length")).alias("coverage"), F.lit(True).alias("same_values")))


def matches(docs: DataFrame, benchmark: DataFrame, covered: float = COVERED) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, text_key (hash of the text),
    item_id, windows (of the item that match), coverage (share of its words), same_values.

    Rows that share doc_id and text give one result; null doc_ids and item_ids are kept; null and
    empty texts match nothing, and so do templates of fewer than LITERALS words that are no slots
    and literal items of fewer than LITERALS words and LEAST_CHARS characters. Items shorter than
    WINDOW words are one window of their own length. Of several occurrences the one that covers
    most counts. Items of one text are all reported.
    """
    items = benchmark.select("item_id", text_of().alias("text")).distinct()
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("text_key", F.xxhash64("text"))
    wanted = {how: _wanted(items, how) for how in (TEMPLATE, NAMELESS, SPOKEN)}
    every = wanted[TEMPLATE].unionByName(wanted[NAMELESS]).unionByName(wanted[SPOKEN])
    rows = cut(_may_hold(rows, every))
    found = (_template(rows, wanted[TEMPLATE], TEMPLATE, covered)
             .unionByName(_template(rows, wanted[NAMELESS], NAMELESS, covered))
             .unionByName(_verbatim(rows, wanted[SPOKEN], covered)))
    return (found.groupBy("doc_id", "text_key", "item_id")
            .agg(F.max("windows").cast("long").alias("windows"), F.max("coverage").alias("coverage"),
                 F.bool_or("same_values").alias("same_values")))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`matches` by doc_id and item_id."""
    return matches(docs, benchmark).select("doc_id", "item_id", "windows", "coverage", "same_values")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark item is found, columns as they came."""
    name, key = unused(docs.columns, "found_id"), unused(docs.columns, "found_key")
    found = matches(docs, benchmark).select(F.col("doc_id").alias(name), F.col("text_key").alias(key)).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(F.col(name)) & (F.xxhash64(text_of()) == F.col(key)),
                     "left_anti")
