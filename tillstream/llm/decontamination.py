"""Benchmark decontamination with a distributed positional inverted index.

The index stores, for every document, the positions of the words that occur in the
test set at all (``postings``); it is written once and then only its lists are read.
A test window's words are ordered from the rarest by the number of their postings. The
lists of the rarest are shifted by their offsets in the window and intersected, which
leaves few places; there the whole window is compared with the document's own words.
Nearly right places, where the rarest words stand at about their distance, are reported
as proximity matches. Everything is DataFrame operations.

Index keys are hashes of fully lower-cased words: coarser than the words compared in
the end, so no match is lost to them and none is made by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstream.llm.common import UPPER, keyed, kept, row_key, small

WINDOW = 10
# So many of a window's words, the rarest, propose its places.
RAREST = 2
# A proximity match may be off by so many words.
SLACK = 3

_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def split_words(text: Column) -> Column:
    """Words of a text and, where it starts or ends with none, an empty one there."""
    return F.split(F.coalesce(text, F.lit("")), _BREAK)


def word_count(parts: Column) -> Column:
    """Words among ``parts`` of ``split_words``."""
    empty = (F.element_at(parts, 1) == "").cast("long") + (F.element_at(parts, -1) == "").cast("long")
    return F.when((F.size(parts) == 1), 1 - (F.element_at(parts, 1) == "").cast("long")).otherwise(
        F.size(parts) - empty
    )


def exact_words(text: Column) -> Column:
    """The words with A-Z lower-cased, without empty ones."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.filter(F.split(lowered, _BREAK), lambda w: w != "")


def _key(word: Column) -> Column:
    return F.xxhash64(F.lower(word))


def item_windows(items: DataFrame, length: int = WINDOW) -> DataFrame:
    """``item``, ``wid``, ``window`` of each distinct window of each item.

    A window is ``length`` words in a row; an item of fewer, but not none, is one window.
    An item without an id marks words but is not listed.
    """
    words = items.select(
        F.col("item_id").cast("string").alias("item"), exact_words(F.col("text")).alias("words")
    ).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - length + 1, F.lit(1)))
    windows = words.select("item", "words", F.explode(starts).alias("at")).select(
        "item", F.slice("words", F.col("at"), length).alias("window")
    )
    return windows.select("item", F.md5(F.concat_ws(" ", "window")).alias("wid"), "window").distinct()


def test_windows(held: DataFrame) -> DataFrame:
    """``wid``, ``phrase``, ``len``, ``sid``, ``window`` of every distinct window of ``held``.

    ``sid`` names the set of items that hold the window, whatever their order and number: it is
    made of sums and XORs of their hashes, so no list of items is ever put together here.
    """
    named = F.xxhash64("item")
    again = F.xxhash64("item", F.lit("again"))
    sums = (F.count("item"), F.bit_xor(named), F.bit_xor(again), F.sum(F.shiftright(named, 40)))
    return held.groupBy("wid").agg(
        F.first("window").alias("window"), F.concat_ws(",", *(x.cast("string") for x in sums)).alias("sid")
    ).select("wid", F.concat_ws(" ", "window").alias("phrase"), F.size("window").alias("len"), "sid", "window")


def set_members(held: DataFrame, windows: DataFrame) -> DataFrame:
    """``sid``, ``item``: the items of each set, from one of the windows that it holds."""
    one = windows.groupBy("sid").agg(F.min("wid").alias("wid"))
    return held.filter("item is not null").select("wid", "item").join(one, "wid").select("sid", "item")


def listed(sets: DataFrame, members: DataFrame) -> DataFrame:
    """``combination``, ``n_items``, ``items_sha256`` for each distinct combination of sets in
    ``sets``, which has ``combination`` and ``sids``.

    Items are listed once for each combination, not for each text that has it.
    """
    wanted = sets.dropDuplicates(["combination"]).select("combination", F.explode("sids").alias("sid"))
    names = F.sort_array(F.collect_set("item"))
    return wanted.join(members, "sid").groupBy("combination").agg(names.alias("names")).select(
        "combination",
        F.size("names").cast("long").alias("n_items"),
        F.sha2(F.array_join("names", ","), 256).alias("items_sha256"),
    )


def window_terms(windows: DataFrame) -> DataFrame:
    """``wid``, ``len``, ``off``, ``key``: the words of each window with their offsets."""
    return windows.select("wid", "len", F.posexplode("window").alias("off", "word")).select(
        "wid", "len", "off", _key(F.col("word")).alias("key")
    )


def postings(texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``key``, ``id``, ``h``, ``pos`` of each word of ``vocabulary`` in every text."""
    parts = split_words(F.col("text"))
    words = texts.select("id", "h", F.posexplode(parts).alias("at", "word")).select(
        "id",
        "h",
        "at",
        F.col("word"),
        _key(F.col("word")).alias("key"),
    )
    vocabulary = vocabulary.select("key").distinct()
    hint = F.broadcast(vocabulary) if small(vocabulary) else vocabulary
    # Positions count from the first part, which is empty where a text starts with no word;
    # all of a text's positions shift alike.
    return words.join(hint, "key").filter("word <> ''").select("key", "id", "h", F.col("at").alias("pos"))


def _lists(index: DataFrame, terms: DataFrame) -> DataFrame:
    """``wid``, ``len``, ``rank``, ``id``, ``h``, ``start``: shifted lists of the rarest words."""
    frequency = index.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    rarest = Window.partitionBy("wid").orderBy("n", "off")
    anchors = kept(
        terms.join(frequency, "key")
        .withColumn("present", F.count(F.lit(1)).over(Window.partitionBy("wid")))
        .filter("present = len")  # a window with a word in no document stands nowhere
        .withColumn("rank", F.row_number().over(rarest))
        .filter(F.col("rank") <= RAREST)
        .select("wid", "len", "off", "key", "rank"),
        "anchors",
    )
    hint = F.broadcast(anchors) if small(anchors) else anchors
    return index.join(hint, "key").select(
        "wid", "len", "rank", "id", "h", (F.col("pos") - F.col("off")).alias("start")
    )


def phrase_places(lists: DataFrame) -> DataFrame:
    """``wid``, ``id``, ``h``, ``start`` where all of a window's lists meet."""
    return (
        lists.groupBy("wid", "len", "id", "h", "start")
        .agg(F.countDistinct("rank").alias("met"))
        .filter(F.col("met") == F.least(F.col("len"), F.lit(RAREST)))
        .select("wid", "id", "h", "start")
    )


def near_places(lists: DataFrame, slack: int = SLACK) -> DataFrame:
    """``wid``, ``id``, ``h``, ``start`` where the two rarest words are up to ``slack`` off.

    Starts are put in bins of ``slack + 1``, so that only neighbouring ones are joined.
    """
    bins = lists.withColumn("bin", F.floor(F.col("start") / (slack + 1)))
    one = bins.filter("rank = 1").withColumn(
        "bin", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1))
    )
    two = bins.filter("rank = 2").select("wid", "id", "h", "bin", F.col("start").alias("other"))
    return (
        one.join(two, ["wid", "id", "h", "bin"])
        .filter((F.col("start") != F.col("other")) & (F.abs(F.col("start") - F.col("other")) <= slack))
        .select("wid", "id", "h", "start")
        .distinct()
    )


def contamination(docs: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """What of the test ``items`` stands in each row of ``docs``.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased, of whole
    texts. Returns ``doc_id``, ``n_words``, ``n_hit`` (words inside any occurrence of any
    window), ``n_items`` and ``items_sha256`` (items with an occurring window, by id),
    ``contaminated``, ``n_near`` (proximity matches). A null or empty text has no words
    and no hits. Every row is judged by its own text, also where ids are null or repeat.
    With no items, or none with words, nothing is contaminated. Other columns of either
    table are not looked at.
    """
    return judged(docs, items, length).drop("id", "h")


def judged(docs: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """The columns of ``contamination``, and ``id`` and ``h`` of ``keyed`` for each row."""
    docs = docs.select("doc_id", "text")
    held = kept(item_windows(items, length), "item-windows")
    windows = kept(test_windows(held), "windows")
    terms = window_terms(windows)
    texts = keyed(docs)
    index = kept(postings(texts, terms), "postings")
    lists = kept(_lists(index, terms), "lists")

    shape = windows.select("wid", "phrase", "len", "sid")
    places = phrase_places(lists).join(
        F.broadcast(shape) if small(shape, 100_000) else shape, "wid"
    )
    candidates = kept(
        places.groupBy("id", "h").agg(
            F.sort_array(F.collect_list(F.struct("start", "len", "phrase", "sid"))).alias("places")
        ),
        "places",
    )
    # The words are split off before the duplicates are dropped, which keeps Spark from
    # splitting them again for each place.
    lead = (F.element_at(split_words(F.col("text")), 1) == "").cast("int")
    ids = candidates.select("id", "h")
    hit_texts = (
        texts.join(F.broadcast(ids) if small(ids) else ids, ["id", "h"], "left_semi")
        .select("id", "h", exact_words(F.col("text")).alias("words"), lead.alias("lead"))
        .dropDuplicates(["id", "h"])
    )
    found = (
        hit_texts.join(candidates, ["id", "h"])
        .select(
            "id",
            "h",
            F.filter(
                F.transform(
                    "places", lambda p: p.withField("start", p["start"] - F.col("lead"))
                ),
                lambda p: (p["start"] >= 0)
                & (F.concat_ws(" ", F.slice("words", p["start"] + 1, p["len"])) == p["phrase"]),
            ).alias("hits"),
        )
        .filter(F.size("hits") > 0)
    )
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("until")),
        lambda s, p: F.struct(
            (
                s["total"]
                + F.greatest(F.lit(0), p["start"] + p["len"] - F.greatest(s["until"], p["start"]))
            ).alias("total"),
            F.greatest(s["until"], p["start"] + p["len"]).alias("until"),
        ),
        lambda s: s["total"],
    )
    sids = F.sort_array(F.array_distinct(F.transform("hits", lambda p: p["sid"])))
    found = found.select("id", "h", covered.alias("n_hit"), sids.alias("sids"))
    found = kept(found.withColumn("combination", F.md5(F.array_join("sids", ";"))), "found")
    names = kept(listed(found, set_members(held, windows)), "listed")
    found = found.join(F.broadcast(names) if small(names) else names, "combination", "left")
    found = found.select("id", "h", "n_hit", "n_items", "items_sha256")
    near = near_places(lists).groupBy("id", "h").agg(F.count(F.lit(1)).alias("n_near"))

    counted = docs.select(
        "doc_id",
        *row_key(),
        word_count(split_words(F.col("text"))).cast("long").alias("n_words"),
    )
    out = counted.join(found, ["id", "h"], "left").join(near, ["id", "h"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        "id",
        "h",
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
    )
