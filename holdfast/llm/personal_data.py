"""Personal data by bootstrapped contextual extraction.

Addresses, network addresses, card and telephone numbers of regular form are the seeds. What stands around an
identifier is a lexical pattern: the two or three tokens before it on its line, or the one before and the one
behind, digits made alike. What might be an identifier without being of regular form, such as a number without
its country code, an address written with `(at)`, a card number that lacks a digit, is a candidate: it has patterns
around it too, and counts as the same instance as a seed when it means the same.

Patterns and the different instances in them make a graph, over the whole corpus. A pattern is as reliable as the
share of reliable instances in it, against everything else with a digit or an `@` that stands in its place, seeds of
other kinds included; candidates nothing is known about count against it by a part. A candidate is as reliable as
the best pattern it occurs in, if that is trusted. Spark computes one from the other in rounds, until the trusted
patterns stay. Candidates in trusted patterns are found. Words of prose around a seed make no trusted pattern
unless many different seeds and little else stand behind them.

What fills a pattern's place is looked for only where the pattern may be one with enough instances, which a bit
set of fixed size tells that is handed to all tasks. It has no false negatives, and what it lets through is joined with
the patterns, so the counts are exact.

Nulls and edges: a null text counts as empty and has no spans; a null identifier is carried through; repeated rows
have a result each, and their instances count once; each scan of a text takes time in proportion to its length; extra
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import ipaddress
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import discard, read_table, staged, written

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
# A pattern needs so many different reliable instances, is trusted from this reliability on, and a candidate nothing
# is known about counts against it by this part.
LEAST_SEEDS, TRUSTED, UNKNOWN = 5, 0.7, 0.25
ROUNDS = 6
FILTER_BITS = 1 << 24

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
CALL = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Candidates.
AT = re.compile(r"\s?[(\[{]\s?at\s?[)\]}]\s?|@|\sat\s", re.IGNORECASE)
DOT = r"(?:\.|\s?[(\[{]\s?dot\s?[)\]}]\s?|\sdot\s)"
HOST = re.compile(rf"[\w-]{{1,63}}(?:{DOT}[\w-]{{1,63}}){{0,8}}", re.IGNORECASE)
DOTTED = re.compile(rf"(?<![\w.])[0-9]{{1,3}}(?:{DOT}[0-9]{{1,3}}){{3}}(?![\w.])", re.IGNORECASE)
COLONS = re.compile(r"(?<![\w:])[0-9A-Fa-f:]{6,39}(?![\w:])")
LOOSE_NUMBER = re.compile(r"(?<![\w+])\(?[0-9]++\)?(?:[\x20./-]{1,2}\(?[0-9]++\)?)*(?!\w)")
LONGEST_LOCAL = 64

TOKEN = re.compile(r"\w+|[^\w\s]")
DIGIT = re.compile(r"[0-9]")
FILLER = re.compile(r"[0-9@]")
REST_OF_TOKEN = re.compile(r"\S*")
BEFORE, BEHIND = 80, 40

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for at, d in enumerate(map(int, reversed(digits))):
        total += d if at % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each is found from its `@`, so that long runs of letters are read once."""
    free, at = 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                free = domain.end()
                yield start, free
        at = text.find("@", max(at + 1, free))


def seeds_in(text: str) -> list[Span]:
    """The identifiers of regular form, by start, then kind."""
    found = [(start, EMAIL, end) for start, end in emails(text)]
    if not DIGIT.search(text):
        return found
    for m in ADDRESS.finditer(text):
        if all(len(part.lstrip("0")) < 4 and int(part.lstrip("0") or "0") < 256 for part in m.group().split(".")):
            found.append((m.start(), IP, m.end()))
    for m in NUMBER.finditer(text):
        if m.end() - m.start() >= 14:
            digits = only_digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), CARD, m.end()))
    if "+" in text:
        for m in CALL.finditer(text):
            if 10 <= len(only_digits(m.group())) <= 15:
                found.append((m.start(), PHONE, m.end()))
    return sorted(found)


def plain_host(text: str) -> str:
    return re.sub(r"\s", "", re.sub(DOT, ".", text, flags=re.IGNORECASE))


def instance_of(kind: int, text: str) -> str:
    """What an identifier means, however it is written."""
    if kind == EMAIL:
        return plain_host(AT.sub("@", text, count=1)).lower()
    if kind == IP:
        return plain_host(text).lower()
    digits = only_digits(text)
    return digits[-10:] if kind == PHONE else digits


def loose_emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0
    for m in AT.finditer(text):
        start, mark = m.start(), m.group()
        lowest = max(free, start - LONGEST_LOCAL)
        while start > lowest and (text[start - 1] in LOCAL or text[start - 1].isalnum()):
            start -= 1
        host = HOST.match(text, m.end()) if start < m.start() else None
        if host is None:
            continue
        spelt_out = re.search(r"dot", host.group(), re.IGNORECASE) and len(re.findall(DOT, host.group(), re.IGNORECASE))
        if mark == "@" or (spelt_out if mark.strip().lower() == "at" else "." in plain_host(host.group())):
            free = host.end()
            yield start, free


def candidates_in(text: str, seeds: list[Span]) -> list[Span]:
    """What might be an identifier and touches no seed, by start, then kind."""
    found = [(start, EMAIL, end) for start, end in loose_emails(text)]
    if DIGIT.search(text):
        for m in DOTTED.finditer(text):
            if all(int(part) < 256 for part in plain_host(m.group()).split(".")):
                found.append((m.start(), IP, m.end()))
        for m in COLONS.finditer(text):
            if m.group().count(":") >= 2 and is_address(m.group()):
                found.append((m.start(), IP, m.end()))
        for m in LOOSE_NUMBER.finditer(text):
            size = len(only_digits(m.group())) if m.end() - m.start() >= 7 else 0
            if 7 <= size <= 15:
                found.append((m.start(), PHONE, m.end()))
            if 12 <= size <= 19:
                found.append((m.start(), CARD, m.end()))
    return [span for span in sorted(found) if not touches(span, seeds)]


def is_address(text: str) -> bool:
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return True


def touches(span: tuple[int, int, int], others: list[Span]) -> bool:
    """Whether a span shares a place with one of `others`, which are in order; those of a kind do not overlap."""
    at = bisect_right(others, (span[2], -1, -1))
    return any(other[2] > span[0] for other in others[max(0, at - len(KINDS)) : at])


def patterns_at(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns around a span; none where no word stands before it."""
    line = text[max(0, start - BEFORE) : start].rpartition("\n")[2]
    left = [DIGIT.sub("0", t) for t in TOKEN.findall(line.lower())][-3:]
    if not any(t[0].isalpha() for t in left):
        return []
    right = TOKEN.search(text[end : end + BEHIND].partition("\n")[0].lower())
    left = ["^"] * (3 - len(left)) + left
    found = [" ".join(["2", *left[1:]]), " ".join(["3", *left])] if left[1] != "^" or left[2][0].isalpha() else []
    if left[2][0].isalpha():
        found.append(" ".join(["1", left[2], "_", DIGIT.sub("0", right.group()) if right else "$"]))
    return [p for p in found if any(t[0].isalpha() for t in p.split(" ")[1:])]


def number_of(text: str) -> int:
    """64 bits of a hash, as a long."""
    return int.from_bytes(xxhash.xxh64_digest(text.encode("utf-8", "surrogatepass")), "big", signed=True)


SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
SLOT = pa.struct(
    [("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("instance", pa.int64()),
     ("patterns", pa.list_(pa.int64()))]
)
NAMED = pa.struct([("number", pa.int64()), ("text", pa.string())])


def slots_of(text: str, spans: list[Span], names: dict[int, str] | None = None) -> list[dict]:
    """The spans with their instance and patterns; spans without a pattern are left out."""
    slots = []
    for start, kind, end in spans:
        patterns = patterns_at(text, start, end)
        if patterns:
            numbers = [number_of(p) for p in patterns]
            if names is not None:
                names.update(zip(numbers, patterns, strict=True))
            instance = number_of(f"{kind} {instance_of(kind, text[start:end])}")
            slots.append({"start": start, "kind": kind, "end": end, "instance": instance, "patterns": numbers})
    return slots


def scanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(number, doc_id, base, seeds, candidates, names) per document: all seeds, and those in patterns, candidates in
    patterns, and what the patterns of seeds are called."""
    id_type = docs.schema[id_col].dataType.simpleString()
    types = [("base", pa.list_(SPAN)), ("seeds", pa.list_(SLOT)), ("candidates", pa.list_(SLOT)), ("names", pa.list_(NAMED))]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in types]
            for text in batch.column(2):
                text = text.as_py() or ""
                base, names = seeds_in(text), {}
                seeds = slots_of(text, base, names)
                candidates = slots_of(text, candidates_in(text, base))
                spans = [{"start": s, "kind": k, "end": e} for s, k, e in base]
                for column, value in zip(columns, (spans, seeds, candidates, list(names.items())), strict=True):
                    column.append(value)
            named = [[{"number": n, "text": t} for n, t in row] for row in columns.pop()]
            arrays = [pa.array(c, t) for c, (_, t) in zip([*columns, named], types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *arrays], ["number", "doc_id", *(n for n, _ in types)]
            )

    slot = "array<struct<start: int, kind: int, end: int, instance: long, patterns: array<long>>>"
    columns = (
        f"number long, doc_id {id_type}, base array<struct<start: int, kind: int, end: int>>, seeds {slot}, "
        f"candidates {slot}, names array<struct<number: long, text: string>>"
    )
    rows = docs.select(F.monotonically_increasing_id().alias("number"), F.col(f"`{id_col}`").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(scan, columns)


def edges_of(found: DataFrame) -> DataFrame:
    """(kind, pattern, instance, seed), each once: which instances occur in which patterns."""
    parts = []
    for column in ("seeds", "candidates"):
        slots = found.select(F.explode(column).alias("slot")).select("slot.kind", "slot.instance", "slot.patterns")
        exploded = slots.select("kind", F.explode("patterns").alias("pattern"), "instance")
        parts.append(exploded.withColumn("seed", F.lit(column == "seeds")))
    return parts[0].union(parts[1]).groupBy("kind", "pattern", "instance").agg(F.max("seed").alias("seed"))


def filter_of(patterns: DataFrame) -> np.ndarray:
    """A bit set of `FILTER_BITS` bits with one set for every pattern; formed in Spark, so no pattern is collected."""
    places = patterns.select(F.pmod("pattern", F.lit(FILTER_BITS)).alias("place"))
    words = places.select(F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, int(place % 64))").alias("bit"))
    bits = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    for word, held in words.groupBy("word").agg(F.bit_or("bit")).collect():  # FILTER_BITS / 64 rows at most
        bits[word] = held
    return bits


def fillers_in(text: str, spans: list[Span]) -> Iterator[tuple[int, int]]:
    """Tokens with a digit or an `@` that touch none of the spans."""
    at = 0
    while found := FILLER.search(text, at):
        start = found.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        at = REST_OF_TOKEN.match(text, found.end()).end()
        if not touches((start, 0, at), spans):
            yield start, at


def fillers(docs: DataFrame, text_col: str, held: np.ndarray) -> DataFrame:
    """(pattern, instance), each once: whatever else stands in the place of an identifier, in patterns of the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(held)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            patterns, instances = [], []
            for text in batch.column(0):
                text = text.as_py() or ""
                if not FILLER.search(text):
                    continue
                base = seeds_in(text)
                for start, end in fillers_in(text, sorted([*base, *candidates_in(text, base)])):
                    for pattern in map(number_of, patterns_at(text, start, end)):
                        place = pattern % FILTER_BITS
                        if int(bits[place >> 6]) >> (place & 63) & 1:
                            patterns.append(pattern)
                            instances.append(number_of(text[start:end]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(patterns, pa.int64()), pa.array(instances, pa.int64())], ["pattern", "instance"]
            )

    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    return texts.mapInArrow(fill, "pattern long, instance long").distinct()


def ranked_patterns(edges: DataFrame, others: DataFrame) -> DataFrame:
    """(kind, pattern, reliability, mass): the trusted patterns, after rounds over the graph of patterns and instances.

    Only the trusted patterns of the last round stay in the shared space.
    """
    spark = edges.sparkSession
    seeds = edges.where("seed").select("kind", "instance").distinct().withColumn("known", F.lit(1.0))
    strangers = edges.where("seed").groupBy("pattern").agg(F.count(F.lit(1)).alias("all_seeds"))
    own = edges.groupBy("kind", "pattern").agg(F.count_if("seed").alias("own_seeds"))
    against = own.join(strangers, "pattern", "left").join(others, "pattern", "left").select(
        "kind",
        "pattern",
        (F.coalesce("all_seeds", F.lit(0)) - F.col("own_seeds") + F.coalesce("n_others", F.lit(0))).alias("against"),
    )
    graph = staged(edges.join(seeds, ["kind", "instance"], "left").select("kind", "pattern", "instance", "known"))
    against = staged(against)
    trusted, path, state = None, None, None
    for _ in range(ROUNDS):
        rows = graph
        if trusted is not None:
            best = graph.join(trusted, ["kind", "pattern"]).groupBy("kind", "instance")
            rows = graph.join(best.agg(F.max("reliability").alias("best")), ["kind", "instance"], "left")
        else:
            rows = graph.withColumn("best", F.lit(None).cast("double"))
        held = F.coalesce("known", "best", F.lit(0.0)).cast("decimal(18,9)")  # decimals add up alike in any order
        mass = rows.groupBy("kind", "pattern").agg(
            F.sum(held).cast("double").alias("mass"), F.count(F.lit(1)).alias("n")
        )
        share = F.col("mass") / (F.col("mass") + F.col("against") + UNKNOWN * (F.col("n") - F.col("mass")) + 1)
        scored = mass.join(against, ["kind", "pattern"]).select("kind", "pattern", "mass", share.alias("reliability"))
        before = path
        trusted, path = written(scored.where((F.col("mass") >= LEAST_SEEDS) & (F.col("reliability") >= TRUSTED)))
        seen = trusted.agg(F.count(F.lit(1)), F.sum(F.xxhash64("kind", "pattern").cast("decimal(38,0)"))).first()
        if before:
            discard(spark, before)
        if seen == state:
            break
        state = seen
    return trusted


def bootstrapped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Per document (number, doc_id, base, found), its seeds and the candidates found beside them as arrays of
    (start, kind, end) in that order; and the trusted patterns (kind, pattern, text, reliability, mass)."""
    scan = staged(scanned(docs, id_col, text_col))
    edges = staged(edges_of(scan))
    often = edges.groupBy("kind", "pattern").agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed"))
    often = often.where(F.col("n") >= LEAST_SEEDS).select("pattern").distinct()
    others = fillers(docs, text_col, filter_of(often)).groupBy("pattern").agg(F.count(F.lit(1)).alias("n_others"))
    edges = edges.join(often, "pattern")  # patterns with fewer instances can never be trusted
    trusted = ranked_patterns(edges, others)
    slots = scan.select("number", F.explode("candidates").alias("slot"))
    slots = slots.select("number", "slot.start", "slot.kind", "slot.end", F.explode("slot.patterns").alias("pattern"))
    hits = slots.join(trusted, ["kind", "pattern"]).select("number", F.struct("start", "kind", "end").alias("span"))
    found = hits.groupBy("number").agg(F.array_sort(F.collect_set("span")).alias("found"))
    empty = F.array().cast("array<struct<start: int, kind: int, end: int>>")
    spans = scan.select("number", "doc_id", "base").join(found, "number", "left")
    names = scan.select(F.explode("names").alias("name")).select(F.col("name.number").alias("pattern"), "name.text")
    named = trusted.join(names.groupBy("pattern").agg(F.min("text").alias("text")), "pattern", "left")
    return spans.withColumn("found", F.coalesce("found", empty)), named


def joined(spans: Column) -> Column:
    kind = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (seeds), base_sha256, spans, n_found."""
    spans, _ = bootstrapped(docs, id_col, text_col)

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda span: span["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return spans.select(
        "doc_id",
        *counts,
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", "found"))).alias("spans"),
        F.size("found").cast("long").alias("n_found"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return personal_data(read_table(spark, sf_dir, "documents"))
