"""Benchmark decontamination by templates, in DataFrame expressions only.

Runs of capitalised words, numbers and units after numbers become typed placeholders, all other words
their lower case.  Windows of eight template words of the corpus meet those of the benchmark by hash; where
too few of the eight are literal words, windows of thirteen do.
Where they lie on one diagonal (the same shift between item and text), the values behind the
placeholders are compared: a re-parameterised question renames each value to one other value, both
ways.  Windows of eight words as they are, in lower case, meet as well, whatever the words are and in
whatever case they are written.  A
text is contaminated by an item if its consistent diagonals and its verbatim windows cover enough of
the item's words.  A template of hardly any literal words fits too many texts to tell anything, so
what has fewer than four of them in thirteen words is found verbatim only.

Texts are looked at closely if they share a run of six words with an item, at any third place of the
text: each window holds one, so none is missed.  Of an item's windows, those that most texts have are left out
as long as they alone cover too little of it; whatever contains the item has one of its others.  So only
these rare windows make pairs of texts and items, and a phrase that many items share makes none.

NULL and empty texts are clean.  Items shorter than a window tell too little to be searched for.  The
verdict depends on the text alone, so repeated rows and equal texts share it; an item that occurs
twice counts under each id.  Each text of an id is searched for on its own, and the id is found with
any of them.  NULL is an id like others.  An empty table or benchmark gives no finding.  Columns of the documents
pass through; working columns take names that the input does not have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanlake.llm.common import let, window_hashes, written

WINDOW = 8
"""Words of a window, a power of two."""

GRAM = 6
"""Words of the runs, within a window, by which texts are chosen that are looked at closely."""

MIN_LITERALS = 4
"""Words of a template window, at least, that are no placeholders."""

MIN_WORDS = 13
"""Words of an item that must be covered, or the whole item if it is shorter.
Template windows of :data:`WINDOW` words with too few literals are looked for at this length."""

PLAIN, SHORT, LONG = 0, 1, 2
"""Windows of words as they are, template windows of :data:`WINDOW` and of :data:`MIN_WORDS` words."""

MIN_AGREEMENT = 0.7
"""Share of the placeholders of a diagonal that follow its most frequent renaming."""

BROADCAST_ROWS = 1_000_000
"""Benchmark windows and found texts, some tens of bytes each, up to which they are broadcast.  Their
number is counted first; beyond it both sides are shuffled."""

# Units of measure in the four languages, with their symbols, in lower case.
UNITS = """
km m cm mm dm nm mi in ft yd kg g mg lb lbs oz t l ml cl dl hl gal pt qt h hr hrs min mins s sec secs ms
mph kmh kph w kw kwh kj cal kcal hz khz mhz ghz ha kb mb gb tb eur usd gbp chf
kilometer kilometers kilometre kilometres meter meters metre metres centimeter centimeters centimetre
centimetres millimeter millimeters millimetre millimetres mile miles yard yards foot feet inch inches
acre acres hectare hectares gram grams gramme grammes kilogram kilograms kilo kilos milligram milligrams
ton tons tonne tonnes pound pounds ounce ounces stone stones liter liters litre litres milliliter
milliliters millilitre millilitres gallon gallons pint pints quart quarts cup cups
hour hours minute minutes second seconds day days week weeks fortnight fortnights month months year years
decade decades century centuries degree degrees percent dollar dollars cent cents euro euros penny pence
pennies watt watts kilowatt kilowatts joule joules calorie calories volt volts
kilometern metern zentimeter zentimetern millimeter millimetern meile meilen fuß zoll elle ellen hektar
gramm kilogramm milligramm tonnen pfund unze unzen litern milliliter millilitern gallone gallonen
stunde stunden minuten sekunde sekunden tag tage tagen woche wochen monat monate monaten jahr jahre jahren
jahrzehnt jahrzehnte jahrhundert jahrhunderte grad prozent dollars franken pfennig kalorie kalorien
kilomètre kilomètres mètre mètres centimètre centimètres millimètre millimètres mille milles pied pieds
pouce pouces verge verges grammes kilogramme kilogrammes milligramme milligrammes livre livres onces
millilitre heure heures seconde secondes jour jours semaine semaines mois ans année années décennie
décennies siècle siècles degré degrés pourcent centime centimes
kilómetro kilómetros metro metros centímetro centímetros milímetro milímetros milla millas pie pies
pulgada pulgadas yarda yardas hectárea hectáreas gramo gramos kilogramo kilogramos miligramo miligramos
tonelada toneladas libra libras onza onzas litro litros mililitro mililitros galón galones
hora horas minuto minutos segundo segundos día días semana mes meses año años década décadas siglo siglos
grado grados dólar dólares céntimo céntimos centavo centavos peso pesos caloría calorías
""".split()
UNIT_WORDS = "|".join(sorted(set(UNITS), key=lambda u: (-len(u), u)))

NAME, NUMBER, UNIT = "\x01", "\x02", "\x03"
PLACEHOLDERS = (NAME, NUMBER, UNIT)
LETTER = r"\p{L}\p{M}'’"
DIGITS = r"\p{Nd}+(?:[.,]\p{Nd}+)*"


MEASURE = rf"{NUMBER}[\s-]+(?iu:{UNIT_WORDS})(?![{LETTER}])"
"""A marked number and its unit, which may be capitalised as a German noun is."""


NAME_WORD = rf"(?<![{LETTER}])\p{{Lu}}\p{{Ll}}[{LETTER}]*+"


def template(text: Column) -> Column:
    """Template words of a text, one for each of its :func:`values`."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), "[\x01-\x03]", " ")
    numbered = F.regexp_replace(plain, DIGITS, f" {NUMBER} ")
    measured = F.regexp_replace(numbered, MEASURE, f"{NUMBER} {UNIT} ")
    named = F.regexp_replace(
        measured, rf"{NAME_WORD}(?:[^{LETTER}\x01-\x03]+{NAME_WORD})*+", f" {NAME} "
    )
    words = F.split(F.lower(named), rf"[^{LETTER}\x01-\x03]+")
    return F.filter(words, lambda w: w != "")


def runs(text: Column) -> Column:
    """The ``value`` of each template word and the place ``at`` of its first word in the text.

    Words of a run of names are joined by blanks, whatever stands between them.
    """
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), "[\x01-\x03]", " ")
    numbered = F.regexp_replace(plain, DIGITS, f" $0{NUMBER} ")
    measured = F.regexp_replace(numbered, MEASURE, f"$0{UNIT} ")
    marked = F.regexp_replace(measured, rf"{NAME_WORD}(?!{UNIT})", f"$0{NAME}")
    words = F.regexp_extract_all(marked, F.lit(f"({DIGITS}{NUMBER}|[{LETTER}]+[{NAME}{UNIT}]?)"), 1)
    name = lambda w, i: F.coalesce(F.endswith(F.get(w, i), F.lit(NAME)), F.lit(False))

    def joined(w: Column, first: Column) -> Column:
        return F.transform(
            first,
            lambda at, k: F.struct(
                F.translate(
                    F.lower(
                        F.array_join(
                            F.slice(w, at + 1, F.coalesce(F.get(first, k + 1), F.size(w)) - at), " "
                        )
                    ),
                    "".join(PLACEHOLDERS),
                    "",
                ).alias("value"),
                at.alias("at"),
            ),
        )

    return let(
        words,
        lambda w: let(
            F.filter(F.transform(w, lambda _, i: i), lambda i: ~(name(w, i) & name(w, i - 1))),
            lambda first: joined(w, first),
        ),
    )


def values(text: Column) -> Column:
    """The words, numbers and names behind the template words of a text, in lower case."""
    return F.transform(runs(text), lambda r: r["value"])


def starts(text: Column) -> Column:
    """Place among the :func:`plain_words` of each template word."""
    return F.transform(runs(text), lambda r: r["at"])


def plain_words(text: Column) -> Column:
    """The words and numbers of a text in lower case, one by one."""
    plain = F.lower(F.translate(F.coalesce(text, F.lit("")), "\x01\x02\x03", "   "))
    return F.regexp_extract_all(plain, F.lit(f"({DIGITS}|[{LETTER}]+)"), 1)


def windows(words: Column) -> Column:
    """Hashes of the windows, by place; empty for fewer words than a window."""
    return window_hashes(F.transform(words, lambda w: F.xxhash64(w)), WINDOW)


def grams(words: Column, step: int) -> Column:
    """Hashes of every ``step``-th run of :data:`GRAM` words."""
    return let(
        words,
        lambda w: F.when(
            F.size(w) >= GRAM,
            F.transform(
                F.sequence(F.lit(1), F.size(w) - (GRAM - 1), F.lit(step)),
                lambda i: F.xxhash64(F.slice(w, i, F.lit(GRAM))),
            ),
        ).otherwise(F.expr("CAST(array() AS array<bigint>)")),
    )


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def probes(words: DataFrame, *names: str) -> DataFrame:
    """``kind``, ``place`` and ``hash`` of all windows of the words ``p`` and template words ``t``."""
    runs = let(
        windows(F.col("t")),
        lambda w: F.struct(
            w.alias("short"),
            F.filter(
                F.zip_with(
                    w, F.slice(w, F.lit(MIN_WORDS - WINDOW + 1), F.size(w)), lambda a, b: F.xxhash64(a, b)
                ),
                lambda _, i: i < F.size(w) - (MIN_WORDS - WINDOW),
            ).alias("long"),
        ),
    )
    kinds = let(
        runs,
        lambda r: F.array(
            F.struct(F.lit(PLAIN).alias("kind"), windows(F.col("p")).alias("w")),
            F.struct(F.lit(SHORT).alias("kind"), r["short"].alias("w")),
            F.struct(F.lit(LONG).alias("kind"), r["long"].alias("w")),
        ),
    )
    return words.select(*names, F.explode(kinds).alias("k")).select(
        *names, "k.kind", F.posexplode("k.w").alias("place", "hash")
    )


def item_windows(known: DataFrame) -> DataFrame:
    """``kind``, ``hash``, ``item`` and ``at`` of the windows to look for."""
    long = F.when(F.col("kind") == LONG, MIN_WORDS).otherwise(WINDOW)
    literal = F.filter(F.slice("t", F.col("place") + 1, long), lambda w: ~w.isin(*PLACEHOLDERS))
    return (
        probes(known, "item", "t")
        .where((F.col("kind") == PLAIN) | (F.size(literal) >= MIN_LITERALS))
        .selectExpr("kind", "hash", "item", "place AS at")
        .distinct()
    )


def counted_broadcast(table: DataFrame) -> DataFrame:
    """The written table, to be broadcast if it has no more than :data:`BROADCAST_ROWS`."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table.hint("merge")


def candidates(docs: DataFrame, known: DataFrame, text: str) -> DataFrame:
    """``key`` and ``text`` of the texts that can have a window of an item, each once.

    Every window holds a run of :data:`GRAM` words at one of the places that are looked at.
    """
    wanted = written(
        known.select(F.explode(F.concat(grams(F.col("t"), 1), grams(F.col("p"), 1))).alias("hash")).distinct(),
        "item-grams",
    )
    step = WINDOW - GRAM + 1
    mine = F.concat(grams(template(F.col(text)), step), grams(plain_words(F.col(text)), step))
    hit = written(
        docs.select(text_key(F.col(text)).alias("key"), mine.alias("grams"))
        .select("key", F.explode_outer("grams").alias("hash"))
        .join(counted_broadcast(wanted), "hash", "left_semi")
        .select("key")
        .distinct(),
        "hits",
    )
    texts = (
        docs.select(text_key(F.col(text)).alias("key"), F.col(text).alias("text"))
        .join(counted_broadcast(hit), "key", "left_semi")
        .groupBy("key")
        .agg(F.first("text").alias("text"))
    )
    return written(texts, "candidates")


def rare_windows(wanted: DataFrame, hits: DataFrame, known: DataFrame) -> DataFrame:
    """``kind``, ``hash`` and ``item`` of windows one of which is in every text that contains the item.

    The windows of an item that most texts have are left out one by one, until those left out cover
    enough words for the item to be found by them alone.
    """
    often = hits.groupBy("kind", "hash").agg(F.count("*").alias("n"))
    windows_of = (
        wanted.join(often, ["kind", "hash"])
        .groupBy("item")
        .agg(F.sort_array(F.collect_list(F.expr("struct(-n AS rank, kind, at, hash)"))).alias("found"))
    )
    long = f"IF(w.kind = {LONG}, {MIN_WORDS}, {WINDOW})"
    more = f"""named_struct(
        'words', array_union(s.words, IF(w.kind = {PLAIN},
            sequence(w.at, w.at + {WINDOW - 1}), slice(starts, w.at + 1, {long}))),
        'slots', array_union(s.slots, IF(w.kind = {PLAIN},
            CAST(array() AS array<int>), sequence(w.at, w.at + {long} - 1))),
        'n', s.n + 1, 'open', true)"""
    enough = f"""size(m.words) >= least(size(p), {MIN_WORDS})
        OR size(m.slots) >= least(size(t), {MIN_WORDS})"""
    shut = "named_struct('words', s.words, 'slots', s.slots, 'n', s.n, 'open', false)"
    left_out = f"""aggregate(found,
        named_struct('words', CAST(array() AS array<int>), 'slots', CAST(array() AS array<int>),
            'n', 0, 'open', true),
        (s, w) -> IF(s.open, get(transform(array({more}), m -> IF({enough}, {shut}, m)), 0), s),
        s -> s.n)"""
    return (
        windows_of.join(known.select("item", "p", "t", "starts"), "item")
        .select("item", "found", F.expr(left_out).alias("n"))
        .select("item", F.expr("explode(slice(found, n + 1, size(found)))").alias("w"))
        .select("w.kind", "w.hash", "item")
        .distinct()
    )


def matches(texts: DataFrame, wanted: DataFrame, known: DataFrame) -> DataFrame:
    """Common windows of the texts and items that can reach the threshold, as a written table."""
    hashes = written(wanted.select("kind", "hash").distinct(), "window-hashes")
    split = texts.select("key", plain_words(F.col("text")).alias("p"), template(F.col("text")).alias("t"))
    hits = written(
        probes(split, "key").join(counted_broadcast(hashes), ["kind", "hash"], "left_semi"), "hits"
    )
    rare = written(rare_windows(wanted, hits, known), "rare-windows")
    pairs = written(
        hits.join(counted_broadcast(rare), ["kind", "hash"]).select("key", "item").distinct(), "pairs"
    )
    return written(
        pairs.join(counted_broadcast(wanted), "item")
        .join(hits, ["key", "kind", "hash"])
        .selectExpr("key", "item", "kind", "place - at AS shift", "at")
        .distinct(),
        "matches",
    )


def findings(
    docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """Contaminated texts: ``key`` (see :func:`text_key`), ``item`` and ``words`` covered."""
    # Items go by the key of their text; their ids come back at the end.
    given = items.select(F.col(item).alias("id"), text_key(F.col(item_text)).alias("item"))
    known = items.select(
        text_key(F.col(item_text)).alias("item"), F.col(item_text).alias("_text")
    ).dropDuplicates(["item"])
    known = known.select(
        "item",
        plain_words(F.col("_text")).alias("p"),
        template(F.col("_text")).alias("t"),
        values(F.col("_text")).alias("theirs"),
        starts(F.col("_text")).alias("starts"),
    )
    wanted = written(item_windows(known), "item-windows")
    texts = candidates(docs, known, text)
    matched = matches(texts, wanted, known)
    # The template words of a diagonal that its windows cover.
    covered = (
        matched.where(F.col("kind") != PLAIN)
        .select(
            "key",
            "item",
            "shift",
            F.explode(
                F.expr(f"sequence(at, at + IF(kind = {LONG}, {MIN_WORDS}, {WINDOW}) - 1)")
            ).alias("at"),
        )
        .distinct()
    )
    pairs = (
        covered.join(texts.select("key", values(F.col("text")).alias("mine")), "key")
        .join(known.select("item", "t", "theirs", "starts"), "item")
        .select(
            "key",
            "item",
            "shift",
            "at",
            F.get("t", F.col("at")).isin(*PLACEHOLDERS).alias("slot"),
            F.get("theirs", F.col("at")).alias("a"),
            F.get("mine", F.col("at") + F.col("shift")).alias("b"),
            F.get("starts", F.col("at")).alias("word"),
        )
    )
    pairs = written(pairs, "slots")
    diagonal = ["key", "item", "shift"]
    # How much of a diagonal follows the most frequent renaming, from either side.
    renamed = (
        pairs.where("slot")
        .groupBy(*diagonal, "a", "b")
        .agg(F.count("*").alias("n"))
        .selectExpr(
            *diagonal,
            "n",
            "row_number() OVER (PARTITION BY key, item, shift, a ORDER BY n DESC, b) AS of_a",
            "row_number() OVER (PARTITION BY key, item, shift, b ORDER BY n DESC, a) AS of_b",
        )
        .groupBy(*diagonal)
        .agg(
            F.expr(
                "least(sum(IF(of_a = 1, n, 0)), sum(IF(of_b = 1, n, 0))) / sum(n) AS agreement"
            )
        )
    )
    renaming = (
        pairs.join(renamed, diagonal, "left")
        .where(F.coalesce("agreement", F.lit(1.0)) >= MIN_AGREEMENT)
        .select("key", "item", "word", F.col("at").alias("slotted"))
    )
    verbatim = matched.where(F.col("kind") == PLAIN).select(
        "key",
        "item",
        F.explode(F.expr(f"sequence(at, at + {WINDOW - 1})")).alias("word"),
        F.lit(None).cast("int").alias("slotted"),
    )
    sizes = known.select("item", F.size("p").alias("n_words"), F.size("t").alias("n_template"))
    most = F.lit(MIN_WORDS)
    return (
        renaming.union(verbatim)
        .groupBy("key", "item")
        .agg(F.count_distinct("word").alias("words"), F.count_distinct("slotted").alias("slotted"))
        .join(sizes, "item")
        .where(
            (F.col("words") >= F.least("n_words", most))
            | (F.col("slotted") >= F.least("n_template", most))
        )
        .join(given, "item")
        .groupBy("key", F.col("id").alias("item"))
        .agg(F.max("words").alias("words"))
    )


def report(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **names: str) -> DataFrame:
    """One row per document: ``contaminated``, ``n_items``, ``item_ids`` and most ``n_words``."""
    found = (
        findings(docs, items, text, **names)
        .groupBy("key")
        .agg(
            F.sort_array(F.collect_set(F.struct("item"))).alias("found"),
            F.max("words").alias("n_words"),
        )
        .select("key", F.col("found.item").alias("item_ids"), "n_words")
    )
    return (
        docs.select(F.col(doc_id).alias("_id"), text_key(F.col(text)).alias("key"))
        .join(found, "key", "left")
        .select(
            F.col("_id").alias(doc_id),
            F.col("item_ids").isNotNull().alias("contaminated"),
            F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
            "item_ids",
            F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words"),
        )
    )


def keep_clean(docs: DataFrame, items: DataFrame, text: str = "text", **names: str) -> DataFrame:
    """Documents that no item contaminates, with their columns as they are."""
    found = written(findings(docs, items, text, **names).select("key").distinct(), "contaminated")
    row = F.struct(*[F.col(f"`{n}`") for n in docs.columns])
    keyed = docs.select(row.alias("row"), text_key(F.col(text)).alias("key"))
    return keyed.join(counted_broadcast(found), "key", "left_anti").select("row.*")
