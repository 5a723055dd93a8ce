"""Personal data by pattern, and information-theoretic sanitisation of the words beside it.

Emails, addresses of machines, card and phone numbers are found by pattern. What is protected is the
value itself, the group it belongs to (domain, network, issuer, area) and its kind, as most values
occur once. Words that keep company with one of these entities all over the corpus, wherever they
stand in its texts, give it away even where the value is masked: the pointwise mutual information of word and entity, relative to the
information that the entity itself carries, says how much. Words above one threshold are generalised
there, above a higher one removed.

Native columns only. Counts cover all documents; a hot value is aggregated before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blobframe.session import materialize, measured

from .common import BROADCAST_KEYS, BROADCAST_ROWS, join_measured, join_stored

KINDS = ("email", "ip", "card", "phone", "term")

# The patterns of the kinds, with the same matches: possessive runs and look-around in place of
# loops over groups, so that neither long runs of characters nor long matches are costly.
_USER = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:(?<!{_USER})|\G){_USER}++@{_LABEL}++(?=\.{_LABEL})"
    rf"(?:(?!\.(?!{_LABEL}))[A-Za-z0-9.-])++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:(?![\x20-](?![0-9]))[0-9\x20-])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain for its kind to be looked for.
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}

WORD = r"\p{L}{2,}+"
#: Entities and words must meet in so many different texts.
MIN_TEXTS = 2
GENERALISE = 0.5
REMOVE = 0.9
MASKS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>", "term": "<TERM>"}


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), n),
        F.lit(0),
        lambda a, i: a
        + F.when((n - i) % 2 == 0, F.substr(digits, i, F.lit(1)).cast("int")).otherwise(
            F.substr(digits, i, F.lit(1)).cast("int") * 2
            - F.when(F.substr(digits, i, F.lit(1)) >= "5", 9).otherwise(0)
        ),
    )
    return total % 10 == 0


def holds(kind: str, hit: Column) -> Column:
    """What a match must pass beyond its pattern."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        small = lambda part: F.length(F.ltrim(part, F.lit("0"))) <= 3
        number = lambda part: F.concat(F.lit("0"), F.ltrim(part, F.lit("0")))
        return F.forall(
            F.split(hit, r"\."),
            lambda part: F.when(small(part), number(part).cast("int") <= 255).otherwise(False),
        )
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)


def matches(text: Column, kind: str) -> Column:
    """Array of (kind, start, end, value) of a kind's matches that hold.

    Places are code points. They come from the pieces between matches, so no text is searched for
    its matches a second time.
    """
    hits = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    gaps = F.split(text, PATTERNS[kind], -1)
    number = KINDS.index(kind)
    none = F.array().cast("array<struct<kind:int,start:int,end:int,value:string>>")
    pairs = F.zip_with(
        hits, F.slice(gaps, 1, F.size(hits)), lambda h, g: F.struct(h.alias("h"), g.alias("g"))
    )
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(state: Column, p: Column) -> Column:
        begin = state["at"] + F.length(p["g"])
        end = begin + F.length(p["h"])
        found = F.struct(
            F.lit(number).alias("kind"), begin.alias("start"), end.alias("end"), p["h"].alias("value")
        )
        out = F.when(holds(kind, p["h"]), F.concat(state["out"], F.array(found)))
        return F.struct(end.alias("at"), out.otherwise(state["out"]).alias("out"))

    found = F.aggregate(pairs, start, step, lambda s: s["out"])
    need = NEEDS[kind]
    present = F.contains(text, F.lit(need)) if need else text.rlike("[0-9][\\x20-]?[0-9]")
    return F.when(present, found).otherwise(none)


def base_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``base``: all base matches, by start and kind. NULL texts have none."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    kinds = [matches(text, kind).alias(f"_{kind}") for kind in KINDS[:4]]
    found = docs.select("*", *kinds)
    every = F.concat(*[F.col(f"_{kind}") for kind in KINDS[:4]])
    by_place = F.array_sort(
        F.transform(every, lambda m: F.struct(m["start"].alias("s"), m["kind"].alias("k"), m.alias("m")))
    )
    found = found.withColumn("base", F.transform(by_place, lambda x: x["m"]))
    return found.drop(*[f"_{kind}" for kind in KINDS[:4]])


def words_beside(text: Column) -> Column:
    """The distinct words of a whole text, without those of its emails; other values hold no letters."""
    rest = F.regexp_replace(text, PATTERNS["email"], " ")
    rest = F.when(F.contains(text, F.lit(NEEDS["email"])), rest).otherwise(text)
    return F.array_distinct(F.regexp_extract_all(F.lower(rest), F.lit(WORD), F.lit(0)))


def marked_words(text: Column, generalised: Column, removed: Column) -> Column:
    """Array of (start, end, removed) of all words of a text that are in one of two arrays of terms."""
    pairs = F.zip_with(
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        F.split(text, WORD, -1),
        lambda w, g: F.struct(w.alias("w"), g.alias("g")),
    )
    none = F.array().cast("array<struct<start:int,end:int,removed:boolean>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(state: Column, p: Column) -> Column:
        first = state["at"] + F.length(p["g"])
        last = first + F.coalesce(F.length(p["w"]), F.lit(0))
        term = F.lower(p["w"])
        gone = F.array_contains(removed, term)
        word = F.struct(first.alias("start"), last.alias("end"), gone.alias("removed"))
        out = F.when(gone | F.array_contains(generalised, term), F.concat(state["out"], F.array(word)))
        return F.struct(last.alias("at"), out.otherwise(state["out"]).alias("out"))

    return F.aggregate(pairs, start, step, lambda s: s["out"])


def entities_of(kind: Column, value: Column) -> Column:
    """What a value gives away: itself, its group and its kind, as an array of strings.

    The group is an email's domain, the first two parts of an address, the first six digits of a
    card number and the first four of a phone number.
    """
    digits = F.regexp_replace(value, "[^0-9]", "")
    groups = [
        F.lower(F.substring_index(value, "@", -1)),
        F.substring_index(value, ".", 2),
        F.substring(digits, 1, 6),
        F.substring(digits, 1, 4),
    ]
    name = F.element_at(F.array(*map(F.lit, KINDS)), kind + 1)
    group = F.element_at(F.array(*groups), kind + 1)
    return F.array(
        F.concat_ws(":", F.lit("value"), name, value),
        F.concat_ws(":", F.lit("group"), name, group),
        F.concat_ws(":", F.lit("kind"), name),
    )


def term_counts(docs: DataFrame, wanted: DataFrame) -> tuple[int, DataFrame]:
    """How many different texts there are, and (term, a): in how many of them a wanted term occurs.

    A row counts as one over the number of rows with its text, so that terms are summed where the
    texts are and no row per text and word is shuffled: few wanted terms are broadcast and pick the
    words before, many are joined with the sums.
    """
    copies = docs.groupBy("t1", "t2").agg(F.count("*").alias("copies"))
    seen, held = measured(copies.where("copies > 1"), "copies", texts=F.count("*"), rows=F.sum("copies"))
    repeated = held["texts"] or 0
    n = docs.count() - (held["rows"] or 0) + repeated
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))
    spread = docs.select("t1", "t2", words.alias("words")).where(F.size("words") > 0)
    few = F.broadcast(seen) if repeated <= BROADCAST_ROWS else seen
    spread = spread.join(few, ["t1", "t2"], "left")
    spread = spread.select(F.explode("words").alias("term"), F.coalesce("copies", F.lit(1)).alias("copies"))
    wanted, held = measured(wanted, "wanted", terms=F.count("*"))
    first = (held["terms"] or 0) <= BROADCAST_ROWS
    if first:
        spread = spread.join(F.broadcast(wanted), "term")
    counted = spread.groupBy("term").agg(F.round(F.sum(1 / F.col("copies"))).cast("long").alias("a"))
    return n, counted if first else counted.join(wanted, "term")


def meetings(hits: DataFrame, held_by: DataFrame, held: DataFrame, min_texts: int) -> DataFrame:
    """(term, entity, c): in how many of the texts both occur, where these are ``min_texts`` or more.

    Entities of fewer texts cannot meet a word in as many, and go first. Pairs are counted where
    the texts are, so none is shuffled or stored by text; entities have numbers on the way.
    """
    numbered = materialize(held.withColumn("number", F.monotonically_increasing_id()), "known")
    known = join_stored(held_by, numbered, ["entity"], "inner")
    known = known.groupBy("t1", "t2").agg(F.collect_list("number").alias("numbers"))
    rows = hits.select("t1", "t2", words_beside(F.col("text")).alias("words"))
    rows = join_measured(rows, known, ["t1", "t2"], "known_by_text", "inner")
    pairs = rows.select(F.explode("words").alias("term"), "numbers")
    pairs = pairs.select("term", F.explode("numbers").alias("number"))
    pairs = pairs.groupBy("term", "number").agg(F.count("*").alias("c")).where(F.col("c") >= min_texts)
    return join_stored(pairs, numbered, ["number"], "inner").select("term", "entity", "c")


def told_words(hits: DataFrame, pairs: DataFrame) -> DataFrame:
    """(t1, t2, term, removed): words of a text that disclose one of its own entities.

    A word meets the text's own entities before it moves, not all that it discloses anywhere. Up to
    BROADCAST_KEYS pairs are broadcast as hashes, so that what discloses nothing is not shuffled.
    """
    told = hits.select(
        "t1",
        "t2",
        F.explode(words_beside(F.col("text"))).alias("term"),
        F.array_distinct("entities").alias("entities"),
    ).select("t1", "t2", "term", F.explode("entities").alias("entity"))
    pairs, held = measured(pairs, "disclosing", pairs=F.count("*"))
    key = F.xxhash64("term", "entity").alias("key")
    if BROADCAST_ROWS < (held["pairs"] or 0) <= BROADCAST_KEYS:
        told = told.withColumn("key", key)
        told = told.join(F.broadcast(pairs.select(key)), "key", "left_semi").drop("key")
    told = join_stored(told, pairs, ["term", "entity"], "inner")
    return told.select("t1", "t2", "term", "removed")


def disclosing_terms(
    docs: DataFrame,
    hits: DataFrame,
    held_by: DataFrame,
    min_texts: int,
    generalise: float,
    remove: float,
) -> DataFrame:
    """(term, entity, removed): words that disclose an entity to more than the threshold.

    n texts; an entity in b of them, a word in a, both in c. The word's information on the entity,
    log2(c n / (a b)), is measured against that of the entity itself, log2(n / b). Texts are counted
    once, however many copies there are.
    """
    held = held_by.groupBy("entity").agg(F.count("*").alias("b")).where(F.col("b") >= min_texts)
    met = materialize(meetings(hits, held_by, held.select("entity"), min_texts), "met")
    n, terms = term_counts(docs.select("t1", "t2", "text"), met.select("term").distinct())
    pairs = join_measured(met, terms, ["term"], "terms", "inner")
    pairs = join_measured(pairs, held, ["entity"], "entities", "inner")
    own = F.log2(F.lit(float(n)) / F.col("b"))
    told = F.log2(F.col("c") * F.lit(float(n)) / (F.col("a") * F.col("b")))
    share = F.when(own > 0, told / own).otherwise(F.lit(0.0))
    pairs = pairs.withColumn("share", share).where(F.col("share") >= generalise)
    return pairs.select("term", "entity", (F.col("share") >= remove).alias("removed"))


def private_spans(
    docs: DataFrame,
    text_col: str = "text",
    min_texts: int = MIN_TEXTS,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
) -> tuple[DataFrame, DataFrame]:
    """Base matches of every document, and the term spans of the texts that have some.

    The first table has the other columns of ``docs``, two hashes of the text (t1, t2) and ``base``;
    the second one t1, t2 and ``terms``, an array of (start, end, removed), a row for a text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashes = [F.xxhash64(F.lit(k), text).alias(f"t{k}") for k in (1, 2)]
    keep = [f"`{c}`" for c in docs.columns if c not in (text_col, "t1", "t2", "base")]
    plain = docs.select(*keep, *hashes, text.alias("text"))
    held = F.when(F.size("base") > 0, F.col("text"))
    found = materialize(base_spans(plain).withColumn("text", held), "base")
    hits = found.where("text is not null").select("t1", "t2", "text", "base")
    entities = F.flatten(F.transform("base", lambda m: entities_of(m["kind"], m["value"])))
    hits = hits.dropDuplicates(["t1", "t2"]).select("t1", "t2", "text", entities.alias("entities"))
    hits = materialize(hits, "hits")
    held_by = hits.select("t1", "t2", F.explode(F.array_distinct("entities")).alias("entity"))
    held_by = materialize(held_by, "held_by")
    pairs = disclosing_terms(plain, hits, held_by, min_texts, generalise, remove)
    # A word that one entity has removed and another generalised is removed.
    marks = told_words(hits, pairs).groupBy("t1", "t2").agg(
        F.collect_set(F.when(~F.col("removed"), F.col("term"))).alias("generalised"),
        F.collect_set(F.when(F.col("removed"), F.col("term"))).alias("removed"),
    )
    marked = join_measured(hits.select("t1", "t2", "text"), marks, ["t1", "t2"], "marks", "inner")
    terms = marked_words(F.col("text"), F.col("generalised"), F.col("removed"))
    return found.drop("text"), marked.select("t1", "t2", terms.alias("terms"))


def spelled(spans: Column) -> Column:
    """kind:start:end of an array of (start, kind, end), comma-joined."""
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"], s["end"])
        ),
        ",",
    )


def find_private(docs: DataFrame, **options) -> DataFrame:
    """Counts of the base kinds, ``base_sha256`` and ``spans`` of every document, without the text.

    NULL and empty texts have no spans. Term spans that touch a base match are left out. Equal texts
    have equal spans; repeated rows each give a row. An empty table gives an empty result.
    """
    found, terms = private_spans(docs, **options)
    both = join_measured(found, terms, ["t1", "t2"], "terms_by_text")
    place = lambda m, kind: F.struct(
        m["start"].cast("int").alias("start"), kind.alias("kind"), m["end"].cast("int").alias("end")
    )
    base = F.transform("base", lambda m: place(m, m["kind"]))
    none = F.array().cast("array<struct<start:int,end:int,removed:boolean>>")
    free = F.filter(
        F.coalesce("terms", none),
        lambda t: ~F.exists("base", lambda m: (m["start"] < t["end"]) & (t["start"] < m["end"])),
    )
    both = both.withColumns({"_base": base, "terms": free})
    extra = F.transform("terms", lambda t: place(t, F.lit(KINDS.index("term"))))

    def of_kind(kind: int) -> Column:
        return F.size(F.filter("_base", lambda m: m["kind"] == kind)).cast("long")

    counts = {f"n_{kind}": of_kind(k) for k, kind in enumerate(KINDS[:4])}
    return both.withColumns(
        counts
        | {
            "base_sha256": F.sha2(spelled(F.col("_base")), 256),
            "spans": spelled(F.array_sort(F.concat("_base", extra))),
            "n_terms": F.size("terms").cast("long"),
        }
    ).drop("_base")


def masked(text: Column, base: Column, terms: Column) -> Column:
    """The text with base matches and disclosing terms replaced; of overlapping ones the longest reach.

    Removed terms leave nothing, generalised ones the name of their kind.
    """
    mask = lambda k: F.element_at(F.array(*[F.lit(MASKS[kind]) for kind in KINDS]), k + 1)
    cuts = F.concat(
        F.transform(
            base,
            lambda m: F.struct(
                m["start"].alias("start"), m["end"].alias("end"), mask(m["kind"]).alias("put")
            ),
        ),
        F.transform(
            terms,
            lambda t: F.struct(
                t["start"].alias("start"),
                t["end"].alias("end"),
                F.when(t["removed"], "").otherwise(MASKS["term"]).alias("put"),
            ),
        ),
    )
    none = F.array().cast("array<string>")
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(state: Column, c: Column) -> Column:
        between = F.substr(text, state["at"] + 1, F.greatest(c["start"] - state["at"], F.lit(0)))
        pieces = F.when(c["start"] >= state["at"], F.array(between, c["put"])).otherwise(none)
        return F.struct(
            F.greatest(state["at"], c["end"]).alias("at"),
            F.concat(state["out"], pieces).alias("out"),
        )

    whole = F.aggregate(
        F.array_sort(cuts),
        start,
        step,
        lambda s: F.concat(
            F.array_join(s["out"], ""), F.substr(text, s["at"] + 1, F.length(text) + 1)
        ),
    )
    return F.when(F.size(cuts) > 0, whole).otherwise(text)


def sanitise(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents with personal data masked and disclosing words generalised or removed.

    Columns and rows stay as they are; NULL texts stay NULL. Texts without findings are unchanged.
    """
    columns = docs.columns
    _, terms = private_spans(docs.select(text_col), text_col, **options)
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashed = docs.select(
        *[F.col(f"`{c}`") for c in columns],
        *[F.xxhash64(F.lit(k), text).alias(f"_t{k}") for k in (1, 2)],
    )
    terms = terms.select(F.col("t1").alias("_t1"), F.col("t2").alias("_t2"), F.col("terms").alias("_terms"))
    both = join_measured(hashed, terms, ["_t1", "_t2"], "masks")
    both = both.withColumnRenamed("base", "_own_base") if "base" in columns else both
    both = base_spans(both, text_col)
    none = F.array().cast("array<struct<start:int,end:int,removed:boolean>>")
    free = F.filter(
        F.coalesce("_terms", none),
        lambda t: ~F.exists("base", lambda m: (m["start"] < t["end"]) & (t["start"] < m["end"])),
    )
    both = both.withColumn("_terms", free)
    new = F.when(F.col(text_col).isNotNull(), masked(F.col(text_col), F.col("base"), F.col("_terms")))
    both = both.withColumn(text_col, new).drop("base")
    both = both.withColumnRenamed("_own_base", "base") if "base" in columns else both
    return both.select(*[F.col(f"`{c}`") for c in columns])
