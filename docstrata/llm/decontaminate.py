"""Benchmark decontamination by template windows, in DataFrame functions throughout.

Words of a text become template tokens: numbers, units after a number, and capitalised names within a sentence turn into
typed placeholders, other words are lower-cased; scripts without spaces give a token per letter. Windows of tokens are hashed, and the
windows of documents joined with those of benchmark items. A window mostly of slots is hashed with their values, so that it meets
its exact copies and not every page with the same pattern of numbers. Windows at one shift between document and item belong
together. Where slots changed, they must map one to one, item value to document value, or the changed windows of the
shift count for nothing; unchanged ones always count. So a question with other names and numbers is found, and every exact copy is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from docstrata.llm.common import documents, free_name, settle

#: Tokens in a window; shorter items are one window of their own length.
WINDOW = 8
#: Shorter items stand everywhere. They are found only where they are all of a document, word for word.
SHORTEST = 4
#: A document holds an item if so many of its tokens match, or this part of them if that is less.
ENOUGH_TOKENS, ENOUGH_PART = 13, 0.8
#: Benchmark windows up to which they are broadcast (about 40 bytes each); beyond it Spark shuffles both sides.
MOST_BROADCAST = 1_000_000

# Units that stand for each other after a number.
UNITS = (
    "mm cm dm m km mi ft in yd mg g kg t lb lbs oz ml cl l gal s sec min h hr hrs hour hours minute minutes second "
    "seconds day days week weeks month months year years kmh mph hz khz mhz ghz w kw mw v a ma pa kpa bar j kj cal kcal "
    "usd eur gbp dollar dollars euro euros cent cents pound pounds percent degrees miles meters metres kilometers "
    "kilometres grams kilograms liters litres inches feet"
).split()
UNIT_WORDS = "|".join(sorted(UNITS, key=lambda u: (-len(u), u)))
NAME_MARK, UNIT_MARK = "\x01", "\x02"
NAME, UNIT, NUMBER = 1, 2, 3
# Letters of scripts that put no spaces between words (Thai, Lao, Burmese, Khmer, kana, Han).
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
TOKEN = r"[\x01\x02]?[0-9]+([.,][0-9]+)*|[\x01\x02]?\p{L}[\p{L}\p{M}]*"


def tokens(text: Column) -> Column:
    """Words and numbers in turn; names and units carry a mark in front. A null text has none."""
    raw = F.coalesce(text, F.lit(""))
    plain = F.regexp_replace(raw, r"[\x01-\x03]", " ")
    apart = F.when(F.octet_length(raw) == F.length(raw), plain).otherwise(F.regexp_replace(plain, f"([{UNSPACED}])", " $1 "))
    # Capitals are found first, so that no name's own letters are used up as the left neighbour of the next.
    capitals = F.regexp_replace(apart, r"(\p{Lu}\p{Ll})", "\x03$1")
    named = F.regexp_replace(capitals, r"([\p{L}\p{N},;:]\s+)\x03", f"$1{NAME_MARK}")
    marked = F.regexp_replace(F.replace(named, F.lit("\x03"), F.lit("")), rf"([0-9]\s?)({UNIT_WORDS})([^\p{{L}}\p{{M}}\p{{N}}]|$)", f"$1{UNIT_MARK}$2$3")
    return F.regexp_extract_all(marked, F.lit(f"({TOKEN})"), F.lit(1))


def is_slot(token: Column) -> Column:
    return F.ascii(token).between(ord(NAME_MARK), ord(UNIT_MARK)) | F.ascii(token).between(ord("0"), ord("9"))


def _codes(found: Column) -> Column:
    """One number per token: its type if it is a slot, else a hash of its lower case."""
    def code(token: Column) -> Column:
        first = F.ascii(token)
        return (
            F.when(first == ord(NAME_MARK), F.lit(NAME).cast("long"))
            .when(first == ord(UNIT_MARK), F.lit(UNIT).cast("long"))
            .when(first.between(ord("0"), ord("9")), F.lit(NUMBER).cast("long"))
            .otherwise(F.xxhash64(F.lower(token)))
        )

    return F.transform(found, code)


def windows(rows: DataFrame, sizes: list[int]) -> DataFrame:
    """Rows of (*, ``tokens``) as one row per window of each size: size, place, hash and slots (null if the row has none at all)."""
    coded = rows.withColumn("codes", _codes(F.col("tokens"))).withColumn("slotted", F.exists("codes", lambda c: c.between(NAME, NUMBER)))
    n = F.size("codes")

    def of_size(size: int) -> Column:
        fits = n == size if size < SHORTEST else n >= size

        def placed(i: Column) -> Column:
            return F.struct(i.alias("at"), F.when(F.col("slotted"), F.filter(F.slice("tokens", i + 1, size), is_slot)).alias("slots"))

        # In a step of its own, since the key asks for the slots again and functions of arrays share nothing between two uses.
        def window(w: Column) -> Column:
            template = F.xxhash64(F.lit(size), *(F.get("codes", w["at"] + k) for k in range(size)))
            words = F.xxhash64(F.lit(-size), *(F.lower(F.get("tokens", w["at"] + k)) for k in range(size)))
            key = words if size < SHORTEST else F.when(2 * F.size(w["slots"]) > size, words).otherwise(template)
            return F.struct(F.lit(size).alias("size"), w["at"].alias("at"), key.alias("key"), w["slots"].alias("slots"))

        places = F.when(fits, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))
        return F.transform(F.transform(places, placed), window)

    kept = [c for c in rows.columns if c != "tokens"]
    found = [of_size(size) for size in sizes]
    return coded.select(*kept, F.inline(F.concat(*found) if len(found) > 1 else found[0]))


def _items(benchmark: DataFrame, text: str, item_id: str) -> DataFrame:
    """Items with the forms their first word can take in running text: what stands before it decides whether it is a name or a unit."""
    found = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), tokens(F.col(f"`{text}`")).alias("tokens"))
    first = F.get("tokens", F.lit(0))
    rest = F.expr("slice(tokens, 2, size(tokens))")
    forms = F.array(
        F.col("tokens"),
        F.when(first.rlike(r"^\p{Lu}\p{Ll}"), F.concat(F.array(F.concat(F.lit(NAME_MARK), first)), rest)),
        F.when(first.isin(*UNITS), F.concat(F.array(F.concat(F.lit(UNIT_MARK), first)), rest)),
    )
    sized = found.where(F.size("tokens") > 0).select("item_id", F.size("tokens").alias("item_tokens"), F.explode(forms).alias("tokens"))
    return sized.where("tokens IS NOT NULL").distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Documents that hold benchmark items: ``doc_id``, ``text_hash``, ``item_id`` and how much of the item was found.

    One row per document and item; rows that repeat id and text count once. Null and empty texts, and texts without a word or number, give
    none. Items shorter than ``SHORTEST`` tokens are found where they are a whole document. Null ids are ids of their own.
    """
    body = F.col(f"`{text}`")
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(body).alias("text_hash"), tokens(body).alias("tokens"))
    items = settle(_items(benchmark, item_text, item_id), "benchmark-tokens")
    size = F.least(F.col("item_tokens"), F.lit(WINDOW))
    sizes = sorted(r["size"] for r in items.select(size.alias("size")).distinct().collect()) or [WINDOW]  # eight at most
    known = windows(items.withColumn("own_size", size), sizes).where("size = own_size").drop("own_size")
    known = settle(known.withColumn("slots", F.coalesce("slots", F.array().cast("array<string>"))).distinct(), "benchmark-windows")
    keys = known.select("key").distinct()
    small = known.count() <= MOST_BROADCAST
    hits = settle(windows(texts, sizes).join(F.broadcast(keys) if small else keys, "key", "left_semi"), "window-hits")
    other = known.select("key", "size", "item_id", "item_tokens", F.col("at").alias("item_at"), F.col("slots").alias("item_slots"))
    met = hits.join(F.broadcast(other) if small else other, ["key", "size"])
    met = met.withColumn("slots", F.coalesce("slots", F.array().cast("array<string>")))
    shift = ["doc_id", "text_hash", "item_id", "item_tokens", "size", F.expr("at - item_at").alias("shift")]
    slots = F.explode_outer(F.arrays_zip("item_slots", "slots"))
    same_at = F.when(F.col("item_slots") == F.col("slots"), F.col("item_at")).alias("same_at")
    pairs = met.select(*shift, "item_at", same_at, slots.alias("pair"))
    shifts = pairs.groupBy("doc_id", "text_hash", "item_id", "item_tokens", "size", "shift").agg(
        F.collect_set("item_at").alias("all_places"), F.collect_set("same_at").alias("same_places"), F.collect_set("pair").alias("pairs")
    )
    n = F.size("pairs")
    one_to_one = (F.size(F.array_distinct("pairs.item_slots")) == n) & (F.size(F.array_distinct("pairs.slots")) == n)
    good = shifts.withColumn("places", F.when(one_to_one, F.col("all_places")).otherwise(F.col("same_places"))).where("size(places) > 0")
    good = good.withColumn("changed", F.size("places") > F.size("same_places"))
    by_item = good.groupBy("doc_id", "text_hash", "item_id", "item_tokens", "size").agg(
        F.array_distinct(F.flatten(F.collect_set("places"))).alias("places"), F.min("changed").alias("reparameterised")
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.col("size") - 1)))))
    counted = by_item.select(
        "doc_id", "text_hash", "item_id", F.size("places").alias("n_windows"), covered.alias("matched_tokens"), "item_tokens", "reparameterised"
    )
    return counted.where(F.col("matched_tokens") >= F.least(F.lit(ENOUGH_TOKENS), F.ceil(F.col("item_tokens") * ENOUGH_PART)))


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", **names: str) -> DataFrame:
    """The documents that hold no benchmark item, all their columns as they were."""
    found = leaks(docs, benchmark, text, doc_id, **names).select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct()
    gone = settle(found, "leaks")
    key, kept = free_name(docs.columns, "text_hash_"), docs.columns
    hashed = docs.withColumn(key, F.xxhash64(F.col(f"`{text}`")))
    same = (hashed[key] == gone["gone_hash"]) & hashed[f"`{doc_id}`"].cast("long").eqNullSafe(gone["gone_id"])
    return hashed.join(gone, same, "left_anti").select(*(f"`{c}`" for c in kept))


def op1_template_windows(spark, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return leaks(documents(spark, sf_dir), benchmark).drop("text_hash")
