"""Personal data, and terms that give it away by their co-occurrence in the corpus."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionlake.llm.common import (
    BITMAP_BITS,
    Remembered,
    importable,
    key_filter,
    small_slices,
    with_held,
)
from sessionlake.llm.exact_dedup import with_possible_repeats
from sessionlake.session import materialize

# The kinds in the contract's order, and its patterns. Those of the e-mail
# address and of the number groups are written so that a long text takes linear time.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")

# Words, numbers and handles, of three characters or more.
_WORD = re.compile(r"[^\W_]\w+[^\W_]")

# A pair of term and entity must share this many different texts to be an estimate.
MIN_CONTEXTS = 2

# Share of an entity's information that a term may disclose, before it is generalised, and
# before it is removed.
GENERALISE, REMOVE = 0.5, 0.8

# Bits of the map of terms: so many for each, within these bounds.
_BITS_PER_TERM = 16
_LEAST_BITS, _MOST_BITS = 1 << 22, 1 << 27
_HELD_WORDS = 200_000

# Up to so many disclosing terms, workers look terms up; more are joined with the texts' words.
HELD_TERMS = 500_000


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, sign and domain, by the signs: the local part is what stands
    before a sign, back to the last match or the first other character."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, entity) of all personal data, by kind, then start.

    The entity is the value without its writing: lower case, or digits only.
    """
    out = [(0, a, b, text[a:b].lower()) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
                out.append((1, *m.span(), ".".join(p or "0" for p in parts)))
        for m in _CARD.finditer(text):
            if m.end() - m.start() <= 40:  # 19 digits with a separator each are 37 characters
                digits = _NOT_DIGIT.sub("", m.group())
                if 13 <= len(digits) <= 19 and _luhn(digits):
                    out.append((2, *m.span(), digits))
        if "+" in text:
            for m in _PHONE.finditer(text):
                digits = _NOT_DIGIT.sub("", m.group())
                if 9 <= len(digits) <= 15:
                    out.append((3, *m.span(), digits))
    return out


def _entities(spans: list[tuple[int, int, int, str]]) -> list[str]:
    return sorted({f"{KINDS[kind]}:{entity}" for kind, _, _, entity in spans})


def words_outside(text: str, spans: list[tuple[int, int, int, str]]) -> Iterator[tuple[str, int, int]]:
    """(word, start, end) of the words of a text that don't overlap any of its spans."""
    taken = sorted((a, b) for _, a, b, _ in spans)
    k = busy = 0
    for m in _WORD.finditer(text):
        start, end = m.span()
        while k < len(taken) and taken[k][0] < end:
            busy = max(busy, taken[k][1])
            k += 1
        if start >= busy:
            yield m.group(), start, end


def text_terms(text: str, spans: list[tuple[int, int, int, str]]) -> set[str]:
    """The different words of a text outside of its spans, in lower case."""
    words = {w for w, _, _ in words_outside(text, spans)} if spans else set(_WORD.findall(text))
    return {w.lower() for w in words}


_FOUND = (
    "doc_id long, text_key string, spans array<struct<kind:int,start:int,end:int>>,"
    " entities array<string>, terms array<string>"
)


def _key(text: Column) -> Column:
    """What tells texts apart: 128 bits; null for null."""
    return F.md5(text.cast("binary"))


def find_entities(docs: DataFrame) -> DataFrame:
    """Base spans and entities of every row of ``docs`` (``doc_id``, ``text``), and the terms of
    those rows that have an entity."""
    importable(docs.sparkSession)
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in small_slices(batches):
            spans, entities, terms = [], [], []
            for text in rows.column("text").to_pylist():
                found = base_spans(text) if text else []
                spans.append([dict(kind=k, start=a, end=b) for k, a, b, _ in found])
                entities.append(_entities(found))
                terms.append(sorted(text_terms(text, found)) if found else [])
            yield pa.record_batch(
                [
                    rows.column("doc_id"),
                    rows.column("text_key"),
                    pa.array(spans, pa.list_(span)),
                    pa.array(entities, pa.list_(pa.string())),
                    pa.array(terms, pa.list_(pa.string())),
                ],
                ["doc_id", "text_key", "spans", "entities", "terms"],
            )

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key(text).alias("text_key"), text.alias("text"))
    return rows.mapInArrow(find, _FOUND)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """Each different text of ``docs`` once, null and empty ones left out: ``text_key``, ``text``.

    Keys are filtered and counted to find those that several rows have; only texts of these are
    shuffled, copies of one task as one row.
    """
    rows = docs.select(F.col("text").cast("string").alias("text")).filter("text <> ''")
    rows = rows.select(_key(F.col("text")).alias("text_key"), "text")
    keys = materialize(rows.select("text_key"), "pii-keys")
    repeated = (
        with_possible_repeats(keys, "text_key", "maybe")
        .filter("maybe")
        .groupBy("text_key")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(F.xxhash64("text_key").alias("hash"))
    )
    tested = with_held(rows, F.xxhash64("text_key"), key_filter(repeated), "held")
    once = tested.filter("held").select("text_key", "text").dropDuplicates(["text_key"])
    alone = tested.filter("not held").select("text_key", "text")
    return alone.unionByName(materialize(once, "pii-repeats"))


def _sketch(terms: DataFrame):
    """A broadcast bit map with the hashes of ``terms``, so that the terms needn't be sent to the
    workers: 16 bits a term, up to 16 MB. Other words may be marked by chance."""
    n = terms.count() * _BITS_PER_TERM
    bits = min(_MOST_BITS, max(_LEAST_BITS, 1 << max(0, n - 1).bit_length()))
    at = F.crc32(F.col("term").cast("binary")) % bits
    maps = (
        terms.select(at.alias("at"))
        .groupBy(F.floor(F.col("at") / BITMAP_BITS).cast("int").alias("part"))
        .agg(F.bitmap_construct_agg(F.col("at") % BITMAP_BITS).alias("map"))
        .collect()  # as many as the map has parts
    )
    marks = bytearray(bits // 8)
    for row in maps:
        marks[row["part"] * 4096 : row["part"] * 4096 + 4096] = row["map"]
    return terms.sparkSession.sparkContext.broadcast(bytes(marks))


def _marked(sketch) -> Remembered:
    marks, last = sketch.value, 8 * len(sketch.value) - 1

    def marked(word: str) -> bool:
        at = zlib.crc32(word.lower().encode("utf-8")) & last
        return bool(marks[at >> 3] >> (at & 7) & 1)

    return Remembered(marked, 150_000)


def text_counts(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """In how many rows of ``texts`` each term occurs: ``term``, ``n``; the empty term has the
    number of rows. Other terms than those of ``terms`` may be there by chance.

    Workers count the words that the bit map marks, before anything moves. Words in base spans
    don't count.
    """
    importable(texts.sparkSession)
    sketch = _sketch(terms)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _marked(sketch)
        n: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["term", "n"])
            n.clear()
            return batch

        for rows in small_slices(batches):
            for text in rows.column("text").to_pylist():
                n[""] += 1
                n.update(filter(wanted.__getitem__, text_terms(text, base_spans(text))))
            if len(n) > _HELD_WORDS:
                yield out()
        if n:
            yield out()

    counted = texts.select("text").mapInArrow(count, "term string, n long")
    return materialize(counted.groupBy("term").agg(F.sum("n").alias("n")), "pii-counts")


def disclosing_terms(texts: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs of term and entity, with the share of the entity's information that the term tells.

    All counts are of different texts of the whole corpus, so copies count once. With N texts,
    an entity e in n(e) of them has the information ``log(N / n(e))``; a term t in n(t) texts
    that stands with it in n(t, e) reveals ``log(N n(t, e) / (n(t) n(e)))`` of it. Pairs that share
    at least `MIN_CONTEXTS` texts and a share of at least `GENERALISE` are returned: entity,
    term, share.
    """
    named = found.filter("size(entities) > 0").select("text_key", "entities", "terms").dropDuplicates(["text_key"])
    named = materialize(named, "pii-named")
    holds = named.select("text_key", F.explode("entities").alias("entity"))
    # an entity in fewer texts has no pair; the terms of texts with such ones only aren't paired
    entities = holds.groupBy("entity").agg(F.count(F.lit(1)).alias("texts")).filter(F.col("texts") >= MIN_CONTEXTS)
    entities = materialize(entities, "pii-entities")
    held = holds.join(entities, "entity").groupBy("text_key").agg(F.collect_list("entity").alias("entities"))
    pairs = materialize(
        named.select("text_key", "terms")
        .join(held, "text_key")
        .select(F.explode("entities").alias("entity"), "terms")
        .select("entity", F.explode("terms").alias("term"))
        .groupBy("entity", "term")
        .agg(F.count(F.lit(1)).alias("both"))
        .filter(F.col("both") >= MIN_CONTEXTS),
        "pii-pairs",
    )
    if pairs.isEmpty():
        return pairs.select("entity", "term", F.lit(0.0).alias("share"))
    counts = text_counts(texts, pairs.select("term").distinct())
    total = counts.filter("term = ''").first()["n"]
    told = F.log(total * F.col("both") / (F.col("n") * F.col("texts")))
    share = told / F.log(F.lit(float(total)) / F.col("texts"))
    return (
        pairs.join(entities, "entity")
        .join(counts, "term")
        .filter(F.col("texts") < total)
        .select("entity", "term", share.alias("share"))
        .filter(F.col("share") >= GENERALISE)
    )


def term_places(texts: DataFrame, terms: DataFrame, everywhere: bool) -> DataFrame:
    """Where in ``texts`` words stand that the bit map of ``terms`` marks: ``text_key``,
    ``entities`` of the text, ``term``, ``places`` (start, end). Texts without an entity are
    left out unless ``everywhere``."""
    importable(texts.sparkSession)
    sketch = _sketch(terms)
    place = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _marked(sketch)
        for rows in small_slices(batches):
            keys, entities, words, places = [], [], [], []
            for key, text in zip(rows.column("text_key").to_pylist(), rows.column("text").to_pylist(), strict=True):
                spans = base_spans(text)
                if not (spans or everywhere):
                    continue
                at: dict[str, list] = {}
                for word, start, end in words_outside(text, spans):
                    if wanted[word]:
                        at.setdefault(word.lower(), []).append((start, end))
                keys += [key] * len(at)
                entities += [[] if everywhere else _entities(spans)] * len(at)
                words += at.keys()
                places += at.values()
            starts = pa.array([a for p in places for a, _ in p], pa.int32())
            ends = pa.array([b for p in places for _, b in p], pa.int32())
            offsets = pa.array(np.cumsum([0, *map(len, places)]), pa.int32())
            yield pa.record_batch(
                [
                    pa.array(keys, pa.string()),
                    pa.array(entities, pa.list_(pa.string())),
                    pa.array(words, pa.string()),
                    pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([starts, ends], fields=list(place))),
                ],
                ["text_key", "entities", "term", "places"],
            )

    return texts.select("text_key", "text").mapInArrow(
        find, "text_key string, entities array<string>, term string, places array<struct<start:int,end:int>>"
    )


def _looked_up(docs: DataFrame, shares: DataFrame) -> DataFrame:
    """The result of `private_spans` everywhere, by a table of ``term``, ``share`` in each worker:
    no row moves."""
    table = shares.toArrow()  # at most HELD_TERMS rows
    known = docs.sparkSession.sparkContext.broadcast(
        dict(zip(table["term"].to_pylist(), table["share"].to_pylist(), strict=True))
    )
    span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    term = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("share", pa.float64())])

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share_of = known.value.get
        for rows in small_slices(batches):
            spans, starts, ends, shares, offsets = [], [], [], [], [0]
            for text in rows.column("text").to_pylist():
                found = base_spans(text) if text else []
                spans.append([dict(kind=k, start=a, end=b) for k, a, b, _ in found])
                for word, start, end in words_outside(text or "", found):
                    share = share_of(word.lower())
                    if share is not None:
                        starts.append(start)
                        ends.append(end)
                        shares.append(share)
                offsets.append(len(starts))
            values = [pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(shares, pa.float64())]
            terms = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(values, fields=list(term))
            )
            yield pa.record_batch(
                [rows.column("doc_id"), rows.column("text_key"), pa.array(spans, pa.list_(span)), terms],
                ["doc_id", "text_key", "spans", "terms"],
            )

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _key(text).alias("text_key"), text.alias("text"))
    return rows.mapInArrow(
        find,
        "doc_id long, text_key string, spans array<struct<kind:int,start:int,end:int>>,"
        " terms array<struct<start:int,end:int,share:double>>",
    )


def private_spans(docs: DataFrame, everywhere: bool = False, held_terms: int = HELD_TERMS) -> DataFrame:
    """All spans of every row of ``docs``: the base ones, and occurrences of disclosing terms.

    Returns doc_id, text_key, spans (kind, start, end) and terms (start, end, share). With
    ``everywhere``, a disclosing term is marked wherever it stands, with the largest share of
    its entities; else in texts that name an entity that it discloses. Null and empty texts have
    no spans; repeated rows have the same. The result doesn't depend on ``held_terms``.
    """
    found = materialize(find_entities(docs), "pii-found")
    texts = distinct_texts(docs)
    telling = materialize(disclosing_terms(texts, found), "pii-terms")
    shares = telling.groupBy("term").agg(F.max("share").alias("share"))
    if everywhere and telling.select("term").distinct().count() <= held_terms:
        return _looked_up(docs, shares)
    places = term_places(texts, telling.select("term").distinct(), everywhere)
    if everywhere:
        told = places.join(shares, "term")
    else:
        told = (
            places.join(telling, "term")
            .filter(F.array_contains("entities", F.col("entity")))
            .groupBy("text_key", "term")
            .agg(F.max("share").alias("share"), F.first("places").alias("places"))
        )
    spans = F.transform("places", lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.col("share")))
    # written, so that the join below has two plain shuffles and Spark can split a hot text
    marked = materialize(
        told.select("text_key", spans.alias("marked"))
        .groupBy(F.col("text_key").alias("_key"))
        .agg(F.sort_array(F.flatten(F.collect_list("marked"))).alias("marked")),
        "pii-marked",
    )
    none = F.array().cast("array<struct<start:int,end:int,share:double>>")
    return found.join(marked, F.col("text_key") == F.col("_key"), "left").select(
        "doc_id", "text_key", "spans", F.coalesce("marked", none).alias("terms")
    )


def _equals(value: int):
    return lambda x: x == value


def span_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns for every row of ``docs``; disclosing terms in all texts."""

    def written(spans, kind):
        return F.transform(
            spans, lambda s: F.concat_ws(":", kind(s), s["start"].cast("string"), s["end"].cast("string"))
        )

    names = F.array(*map(F.lit, KINDS))
    base = written(F.col("spans"), lambda s: F.get(names, s["kind"]))
    more = written(F.col("terms"), lambda s: F.lit(TERM))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        F.size(F.filter(kinds, _equals(k))).cast("long").alias(f"n_{name}")
        for k, name in enumerate(KINDS)
    ]
    return private_spans(docs, everywhere=True).select(
        "doc_id",
        *counts,
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, more), ",").alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
    )


def sanitise_text(text: str, spans: list, terms: list) -> str:
    """Base spans become their kind in brackets; terms ``[TERM]``, or nothing if they tell
    most of the entity. Of overlapping spans, the first by start, then the longest, is done."""
    marks = [(s["start"], s["end"], f"[{KINDS[s['kind']].upper()}]") for s in spans]
    marks += [(t["start"], t["end"], "" if t["share"] >= REMOVE else "[TERM]") for t in terms]
    out, done = [], 0
    for start, end, new in sorted(marks, key=lambda m: (m[0], -m[1])):
        if start >= done:
            out += [text[done:start], new]
        done = max(done, end)
    return "".join([*out, text[done:]])


def sanitise(docs: DataFrame, everywhere: bool = False) -> DataFrame:
    """``doc_id`` and ``text`` of every row of ``docs`` with all spans sanitised.

    ``everywhere`` is that of `private_spans`. A null text stays null. Only documents that have a span are joined with their spans.
    """
    importable(docs.sparkSession)
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), _key(text).alias("text_key"))
    spans = (
        private_spans(docs, everywhere)
        .filter("size(spans) > 0 or size(terms) > 0")
        .dropDuplicates(["doc_id", "text_key"])
        .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "spans", "terms")
    )
    same = rows["doc_id"].eqNullSafe(spans["_id"]) & (rows["text_key"] == spans["_key"])

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_slices(batches):
            texts = [
                sanitise_text(r["text"], r["spans"], r["terms"]) if r["spans"] is not None and r["text"] else r["text"]
                for r in batch.to_pylist()
            ]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.join(spans, same, "left").select("doc_id", "text", "spans", "terms").mapInArrow(
        clean, "doc_id long, text string"
    )
