"""Information-theoretic sanitisation of personal data, in DataFrame operations only.

1. Base spans (email, ip, card, phone) by patterns. Their values are the protected entities.
2. Terms of the documents that have an entity (words of `LETTERS` letters or more, two in scripts of long characters) co-occur with it. From the documents that
   have the entity, the term and both, pointwise mutual information tells how much of the entity's information
   content a term gives away: PMI(term, entity) / IC(entity), 1 if the term occurs nowhere else.
3. Terms over the disclosure threshold, seen with the entity in `SUPPORT` different texts or more, become spans of the kind `term`
   wherever they stand in a document that has it. `sanitised` replaces spans by their kind.

The patterns are written so that each text is scanned in linear time (possessive runs that begin where no run goes on), and
find the same matches as the plain ones. Only documents whose entities have the support give terms, and a term
that such documents have too often for an entity to disclose it isn't paired with it. Document frequencies come from all documents; the terms looked up are those with enough support, and
words are counted in the task before they are shuffled where these are too many to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free, small_batches, store

KINDS = ["email", "ip", "card", "phone", "term"]
#: A run starts where the character before isn't of the run, or where the last match ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
LUHN = """element_at(transform(array(reverse(regexp_replace(x, '[^0-9]', ''))), d -> aggregate(sequence(1, length(d)), 0L, (a, i) -> a +
  CASE WHEN i % 2 = 1 THEN int(substr(d, i, 1)) ELSE (2 * int(substr(d, i, 1))) % 10 + (2 * int(substr(d, i, 1))) div 10 END)), 1) % 10 = 0"""
VALID = {
    "email": "true",
    "ip": rf"x rlike r'^{PART}(?:\.{PART}){{3}}$'",
    "card": f"CASE WHEN length(x) < 14 OR length(regexp_replace(x, '[^0-9]', '')) NOT BETWEEN 14 AND 19 THEN false ELSE {LUHN} END",
    "phone": "length(regexp_replace(x, '[^0-9]', '')) BETWEEN 10 AND 15",
}

LETTERS, SUPPORT, DISCLOSURE = 4, 3, 0.9
WORD = rf"\p{{L}}{{{LETTERS},}}+|[\p{{IsHan}}\p{{IsHiragana}}\p{{IsKatakana}}\p{{IsHangul}}]{{2,}}+"
#: Pieces in which words are placed; none ends within a run of letters.
PIECE = r"(?s).{1,512}+\p{L}*+"
#: Terms whose document frequency is looked up by broadcast, at most.
BROADCAST_TERMS = 1 << 18


def _found(kind: str) -> Column:
    """Spans (s, e, v) of the kind from columns m_<kind> (all matches) and p_<kind> (what is between them)."""
    m, p = f"m_{kind}", f"p_{kind}"
    return F.expr(f"""transform(filter(sequence(0, size({m}) - 1), i -> element_at(transform(array({m}[i]), x -> {VALID[kind]}), 1)),
      i -> named_struct('s', aggregate(slice({p}, 1, i + 1), 0, (a, x) -> a + length(x)) + aggregate(slice({m}, 1, i), 0, (a, x) -> a + length(x)), 'v', {m}[i]))""")


def with_base(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with base: all base spans (s, k, e, v) by start, then kind; k counts KINDS. A null text has none."""
    kinds = list(PATTERNS)
    quick = {"email": F.col(text).contains("@"), "ip": F.col(text).contains("."), "card": F.lit(True), "phone": F.col(text).contains("+")}
    none = F.expr("cast(array() as array<string>)")
    names = docs.columns
    some = F.coalesce(F.col(text), F.lit("")).rlike("[@0-9]")
    df = docs.select("*", *[F.when(some & quick[k], F.regexp_extract_all(text, F.lit(PATTERNS[k]), F.lit(0))).otherwise(none).alias(f"m_{k}") for k in kinds])
    any_valid = {k: F.expr(f"exists(m_{k}, x -> {VALID[k]})") for k in kinds}
    df = df.select(*names, *[F.when(any_valid[k], F.col(f"m_{k}")).otherwise(none).alias(f"m_{k}") for k in kinds])
    df = df.select("*", *[F.when(F.size(f"m_{k}") > 0, F.split(text, PATTERNS[k], -1)).otherwise(none).alias(f"p_{k}") for k in kinds])
    empty = F.expr("cast(array() as array<struct<s:int,k:int,e:int,v:string>>)")

    def of(n: int) -> Column:
        whole = lambda x: F.struct(x["s"].alias("s"), F.lit(n).alias("k"), (x["s"] + F.length(x["v"])).alias("e"), x["v"].alias("v"))
        return F.when(F.size(f"m_{kinds[n]}") > 0, F.transform(_found(kinds[n]), whole)).otherwise(empty)

    spans = [of(n) for n in range(len(kinds))]
    return df.select(*names, F.sort_array(F.concat(*spans)).alias("base"))


def _words(piece: Column, shift: Column) -> Column:
    """Words (s, e, t) of a piece that begins at `shift`."""
    m, p = F.regexp_extract_all(piece, F.lit(WORD), F.lit(0)), F.split(piece, WORD, -1)
    at = F.transform(
        F.arrays_zip(m.alias("m"), F.sequence(F.lit(0), F.size(m)).alias("i")),
        lambda x: F.struct(
            (F.aggregate(F.slice(p, F.lit(1), x["i"] + 1), F.lit(0), lambda a, y: a + F.length(y)) + F.aggregate(F.slice(m, F.lit(1), x["i"]), F.lit(0), lambda a, y: a + F.length(y))).alias("s"),
            x["m"].alias("t"),
        ),
    )
    whole = F.filter(at, lambda x: x["t"].isNotNull())
    return F.transform(whole, lambda x: F.struct((x["s"] + shift).alias("s"), (x["s"] + shift + F.length(x["t"])).alias("e"), F.lower(x["t"]).alias("t")))


def _entities(base: DataFrame, *keys: str) -> DataFrame:
    return base.where(F.size("base") > 0).select(*keys, F.explode(F.array_distinct(F.transform("base", lambda x: F.concat_ws(":", x["k"].cast("string"), x["v"])))).alias("entity"))


def supported(base: DataFrame) -> DataFrame:
    """(key, entity): the distinct texts of each entity that SUPPORT of them or more have."""
    held = _entities(base.select("key1", "key2", "base").where(F.size("base") > 0).dropDuplicates(["key1", "key2"]), "key1", "key2")
    return held.join(held.groupBy("entity").agg(F.count("*").alias("texts")).where(F.col("texts") >= SUPPORT), "entity", "left_semi").select("key1", "key2", "entity")


def whole_terms(base: DataFrame, held: DataFrame) -> DataFrame:
    """(key, s, e, term): words of the distinct texts in `held`, but not in a base span."""
    one = base.where(F.size("base") > 0).select("key1", "key2", "text", "base").dropDuplicates(["key1", "key2"]).join(held.select("key1", "key2").distinct(), ["key1", "key2"], "left_semi")
    cut = one.select("key1", "key2", "base", F.regexp_extract_all("text", F.lit(PIECE), F.lit(0)).alias("pieces"))
    shift = F.transform(F.sequence(F.lit(0), F.size("pieces") - 1), lambda i: F.aggregate(F.slice("pieces", F.lit(1), i), F.lit(0), lambda a, y: a + F.length(y)))
    each = cut.select("key1", "key2", "base", F.explode(F.arrays_zip(F.col("pieces").alias("piece"), shift.alias("shift"))).alias("x"))
    words = each.select("key1", "key2", "base", F.explode(_words(F.col("x.piece"), F.col("x.shift"))).alias("w"))
    apart = ~F.exists("base", lambda x: (x["s"] < F.col("w.e")) & (x["e"] > F.col("w.s")))
    return words.where(apart).select("key1", "key2", "w.s", "w.e", F.col("w.t").alias("term"))


def disclosing(base: DataFrame, held: DataFrame, found: DataFrame, docs: DataFrame) -> DataFrame:
    """(entity, term, share): pairs over the threshold, with the share of the entity's information that the term gives away."""
    copies = base.where(F.size("base") > 0).groupBy("key1", "key2").agg(F.count("*").alias("n"))
    terms = found.select("key1", "key2", "term").distinct().join(copies, ["key1", "key2"])
    least = terms.groupBy("term").agg(F.sum("n").alias("n_near"), F.count("*").alias("texts")).where(F.col("texts") >= SUPPORT).select("term", "n_near")
    entities = _entities(base).groupBy("entity").agg(F.count("*").alias("n_entity"))
    total = F.lit(float(base.count()))
    odds = total / F.col("n_entity")
    # A term's frequency is at least that in these documents, and over n_both * odds ** (1 - DISCLOSURE) it can't reach the threshold; n_both is n_entity at most.
    within = lambda n: (odds > 1) & (F.col("n_near") <= F.col(n) * F.pow(odds, F.lit(1 - DISCLOSURE)) * (1 + 1e-9))
    pairs = held.join(entities, "entity").join(terms.join(least, "term"), ["key1", "key2"]).where(within("n_entity"))
    both = pairs.groupBy("entity", "term", "n_entity", "n_near").agg(F.sum("n").alias("n_both"), F.count("*").alias("support")).where((F.col("support") >= SUPPORT) & within("n_both"))
    both = store(both.select("entity", "term", "n_both", "n_entity"))
    if not both.take(1):
        return both.select("entity", "term", F.lit(1.0).alias("share"))
    asked = store(both.select("term").distinct())
    words = docs.select(F.explode(F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lower))).alias("term"))
    if asked.count() <= BROADCAST_TERMS:
        frequency = words.join(F.broadcast(asked), "term").groupBy("term").agg(F.count("*").alias("n_term"))
    else:
        frequency = words.groupBy("term").agg(F.count("*").alias("n_term")).join(asked, "term", "left_semi")
    mutual = F.log2(F.col("n_both") * total / (F.col("n_entity") * F.col("n_term")))
    told = both.join(frequency, "term")
    return told.select("entity", "term", (mutual / F.log2(odds)).alias("share")).where(F.col("share") >= DISCLOSURE)


def findings(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, key1 and key2 (hashes of the text), base and spans (all spans, s, k, e, by start, then kind).

    A null text is an empty one and has no spans. Equal texts have equal spans; repeated rows stay repeated. Documents
    without entities, and no documents, give no terms. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = with_base(docs).select("doc_id", F.xxhash64("text").alias("key1"), F.hash("text").alias("key2"), "base", F.when(F.size("base") > 0, F.col("text")).alias("text"))
    base = store(keyed)
    held = store(supported(base))
    found = store(whole_terms(base, held))
    pairs = disclosing(base, held, found, docs)
    term = F.struct("s", F.lit(KINDS.index("term")).alias("k"), "e")
    told = held.join(pairs, "entity").select("key1", "key2", "term").distinct()
    added = found.join(told, ["key1", "key2", "term"]).groupBy("key1", "key2").agg(F.collect_set(term).alias("added"))
    plain = F.transform("base", lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))
    own = base.where(F.size("base") > 0).select("doc_id", "key1", "key2", "base").join(added, ["key1", "key2"], "left")
    own = own.select("doc_id", "key1", "key2", "base", F.sort_array(F.concat(plain, F.coalesce("added", F.expr("cast(array() as array<struct<s:int,k:int,e:int>>)")))).alias("spans"))
    return own.unionByName(base.where(F.size("base") == 0).select("doc_id", "key1", "key2", "base", plain.alias("spans")))


def sanitised(docs: DataFrame) -> DataFrame:
    """`docs` with clean: `text` with each span replaced by its kind in brackets (of spans that overlap, by the first's). Null stays null."""
    found = findings(docs).where(F.size("spans") > 0).select("key1", "key2", "spans").dropDuplicates(["key1", "key2"])
    docs = docs.drop("clean")
    one, two, spans = (free(docs.columns, n) for n in ("text_key1", "text_key2", "text_spans"))
    found = found.withColumnRenamed("spans", spans)
    keyed = docs.withColumns({one: F.xxhash64("text"), two: F.hash("text")})
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a, x):
        fresh = F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, x["s"] - a["at"]), F.element_at(names, x["k"] + 1))
        return F.struct(F.greatest(a["at"], x["e"]).alias("at"), F.when(x["s"] >= a["at"], fresh).otherwise(a["out"]).alias("out"))

    clean = F.aggregate(spans, state, step, lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text"))))
    joined = keyed.join(found, (keyed[one] == found["key1"]) & (keyed[two] == found["key2"]), "left")
    return joined.select(*[keyed[c] for c in docs.columns], F.when(F.col(spans).isNull(), F.col("text")).otherwise(clean).alias("clean"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term."""
    names = F.array(*[F.lit(k) for k in KINDS])
    text = lambda spans: F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))))
    n = lambda k: F.size(F.filter("spans", lambda x: x["k"] == k)).cast("long")
    counts = [n(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return findings(docs).select("doc_id", *counts[:4], F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"), counts[4])
