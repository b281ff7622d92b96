"""Language identification by Bayesian fusion of evidence.

Four sources of evidence meet in one posterior per row: the likelihood of the text under a
character trigram model of each language, the language its markup (or its table) declares, the
suffix of its address, and its host's prior. How far a declaration or a suffix can be trusted is
counted over all rows against what the text says. Host priors are smoothed along the hierarchy
host, domain, suffix, everything, each level from one grouped aggregation over all rows, so a
host with few rows leans on its domain. A row without one kind of evidence is judged by the rest.

The trigram model is the only part fitted on a sample: of each declared language the rows of
smallest id digest, all of them where a language has few, so that a language is modelled however
small its share of the corpus. Text of no known script or no letters is ``und``; but text with
letters whose declared language the model does not know is taken at its word.
"""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, functions as F

from starloom.llm.arrow import map_texts, stored, tidy, unused
from starloom.llm.near import BROADCAST_ROWS

#: labelled rows the trigram model is fitted on, rows a language may have whatever the number of
#: languages, languages at most, and buckets of its table
SAMPLE, LEAST_SAMPLE, MOST_LANGUAGES, BUCKETS = 4_000, 100, 256, 1 << 15
#: rows of the level above that a level's counts are mixed with, trust of the text in nats a
#: trigram, rows the least for a declared label to become a language
SMOOTHING, TRUST, LEAST_ROWS = 20.0, 0.25, 3
#: a row is kept when the posterior of its language reaches this
KEEP = 0.5
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point to its lower-case letter, everything else to a space."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(sys.maxunicode + 1):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every letter trigram, word ends included, and the row it belongs to. No
    trigram reaches from one row into the next."""
    points = np.frombuffer(("  " + "".join([t + "   " for t in texts])).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)) + 3)
    folded = _letters()[points]
    a, b, c = folded[:-2], folded[1:-1], folded[2:]
    good = (b != 32) | ((a != 32) & (c != 32))
    mixed = (a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA77) + np.uint32(0x27D4EB2F)) ^ (c * np.uint32(0xC2B2AE3D))
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    return (mixed[good] >> np.uint32(17)).astype(np.int64), row[good]


def _primary(column: str) -> F.Column:
    """The language of a declaration, without region and script."""
    return F.lower(F.split(F.trim(column), "[-_]")[0])


def _quota(counts: list[int], sample: int) -> int:
    """Rows of each language, so that all have ``sample`` together; ``counts`` ascending."""
    left = sample
    for i, n in enumerate(counts):
        fair = left // (len(counts) - i)
        if n > fair:
            return fair
        left -= n
    return max(counts)


def fit(rows: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities per bucket, the undetermined one last: it gives
    every bucket the same. ``rows`` has id, text and declared; about ``sample`` rows count, dealt
    to the declared languages by the number of rows each has in the whole table."""
    labelled = rows.where("declared is not null and trim(declared) <> '' and text is not null and id is not null")
    labelled = labelled.withColumn("declared", _primary("declared"))
    # the most frequent languages; texts of any other keep their declaration
    held = labelled.groupBy("declared").count().orderBy(F.desc("count"), "declared").limit(MOST_LANGUAGES).collect()
    counts = {r["declared"]: r["count"] for r in held if r["count"] >= LEAST_ROWS}
    if not counts:
        return [UNDETERMINED], np.full((BUCKETS, 1), -np.log(BUCKETS), np.float32)
    quota = max(_quota(sorted(counts.values()), sample), LEAST_SAMPLE)
    # a language of more rows gives those whose digest lies in its share of all digests
    share = F.create_map(*[x for name, n in counts.items() for x in (F.lit(name), F.lit(min(1.0, quota / n)))])
    place = F.xxhash64(F.col("id").cast("string")).bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52)
    taken = labelled.where(place < F.element_at(share, F.col("declared"))).select("text", "declared")

    def make():
        def work(part):
            language = np.array(part.column("declared").to_pylist())
            bucket, row = trigrams(part.column("text").to_pylist())
            out = []
            for name in np.unique(language).tolist():
                mine = np.bincount(bucket[(language == name)[row]], minlength=BUCKETS)
                at = np.flatnonzero(mine)
                out.append((np.repeat(name, len(at) + 1), np.append(at, -1), np.append(mine[at], (language == name).sum())))
            return [np.concatenate(c).tolist() for c in zip(*out)] if out else [[], [], []]

        return work

    counted = map_texts(taken, "text", "language string, bucket int, n bigint", make)
    # languages times buckets at most
    got = counted.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas()
    rows_of, got = got[got.bucket < 0], got[got.bucket >= 0]  # bucket -1 counts the rows
    names = sorted(rows_of.language[rows_of.n >= LEAST_ROWS].tolist())
    table = np.full((BUCKETS, len(names) + 1), -np.log(BUCKETS), np.float32)
    for i, name in enumerate(names):
        mine = got[got.language == name]
        counts = np.zeros(BUCKETS)
        counts[mine.bucket.to_numpy(np.int64)] = mine.n.to_numpy()
        table[:, i] = np.log((counts + 0.05) / (counts.sum() + 0.05 * BUCKETS))
    return [*names, UNDETERMINED], table


def likelihoods(rows: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """The rows without text, with ``grams`` (trigrams seen), ``likely`` (log likelihood per
    language) and ``said`` (number of the language the text alone suggests, null without letters)."""
    table = model[1]

    def make():
        def work(part):
            bucket, row = trigrams([t or "" for t in part.column("text").to_pylist()])
            n = part.num_rows
            total = np.stack([np.bincount(row, table[bucket, k], n) for k in range(table.shape[1])], 1)
            grams = np.bincount(row, minlength=n)
            said = np.where(grams > 0, total.argmax(1), -1)
            return [part.column("id"), part.column("declared"), part.column("host"), grams.tolist(),
                    list(total), [None if s < 0 else s for s in said.tolist()]]

        return work

    id_type = rows.schema["id"].dataType.simpleString()
    return map_texts(rows, "text", f"id {id_type}, declared string, host string, grams bigint, "
                                   "likely array<double>, said int", make)


def _counts(df: DataFrame, keys: list[str], size: int, name: str) -> DataFrame:
    """Rows per key and language of the text, as an array; summed map-side."""
    sums = [F.sum((F.col("said") == k).cast("double")).alias(f"_{k}") for k in range(size)]
    return df.groupBy(*keys).agg(*sums).select(*keys, F.array(*[F.col(f"_{k}") for k in range(size)]).alias(name))


def identify(df: DataFrame, id_col: str, text_col: str, declared_col: str | None = None, host_col: str | None = None,
             model: tuple | None = None, languages: list[str] | None = None) -> DataFrame:
    """Per row: id, lang, confidence, declared, keep.

    ``host_col`` holds an address (its host is taken) or a plain host name. ``languages`` names
    those to keep, all but the undetermined one if None. Null or empty text, declarations and
    hosts are no evidence; a row without letters is undetermined and not kept. A row with letters
    and a declared language that the model does not know has that language where the text is
    undetermined, and is kept. Repeated ids and rows are judged one by one. Empty tables give no rows. Clashing extra columns are not read.
    """
    none = F.lit(None).cast("string")
    address = F.lower(F.col(host_col).cast("string")) if host_col else none
    host = F.coalesce(F.nullif(F.regexp_extract(address, r"^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1), F.lit("")), address)
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                     (F.col(declared_col).cast("string") if declared_col else none).alias("declared"), host.alias("host"))
    names, table = model or fit(rows)
    scored = likelihoods(rows, (names, table))
    low = _primary("declared")
    declared = F.when(low.isin(names), low).otherwise(F.when(low != "", F.lit("other")))
    labels = F.split(F.nullif("host", F.lit("")), r"\.")
    suffix = F.when(F.size(labels) > 1, F.element_at(labels, -1))
    domain = F.when(F.size(labels) > 1, F.concat_ws(".", F.slice(labels, -2, 2)))
    scored = stored(scored.withColumns({"_declared": declared, "_low": low, "_suffix": suffix, "_domain": domain}), "language")
    size = len(names)
    known = scored.where("said is not null")
    # three small tables: kinds of declaration and suffixes are few, and sent as literal rows
    overall = known.groupBy().agg(*[F.sum((F.col("said") == k).cast("double")).alias(str(k)) for k in range(size)]).first()
    overall = np.array([overall[k] or 0.0 for k in range(size)])
    base = (overall + 1) / (overall + 1).sum()
    declares = _counts(known.where("_declared is not null"), ["_declared"], size, "n").collect()
    trust = _given({r["_declared"]: np.array(r["n"]) for r in declares}, size)
    suffixes = _counts(known.where("_suffix is not null"), ["_suffix"], size, "_by_suffix")
    domains = _counts(known.where("_domain is not null"), ["_domain"], size, "_by_domain")
    hosts = _counts(known.where("host is not null"), ["host"], size, "_by_host")
    levels = scored
    for table_, key in ((hosts, "host"), (domains, "_domain"), (suffixes, "_suffix")):
        table_ = stored(table_, "levels")
        # the hottest host may own a third of the rows: they stay where they are while hosts are few
        levels = levels.join(F.broadcast(table_) if table_.count() <= BROADCAST_ROWS else table_, key, "left")
    chosen = set(languages) if languages is not None else None
    modelled = set(names)  # a declaration of the undetermined language says nothing

    def fuse(batches):
        import pyarrow as pa

        for batch in batches:
            n = batch.num_rows
            prior = np.repeat(base[None, :], n, 0)
            own = np.eye(size)[[s if s is not None else 0 for s in batch.column("said").to_pylist()]].reshape(n, size)
            for level in ("_by_suffix", "_by_domain", "_by_host"):
                lists = batch.column(level).to_pylist()
                have = np.array([v is not None for v in lists], bool)
                if have.any():
                    # the row itself is not evidence for its own host
                    counts = np.maximum(np.array([v for v in lists if v is not None]) - own[have], 0)
                    prior[have] = (counts + SMOOTHING * prior[have]) / (counts.sum(1, keepdims=True) + SMOOTHING)
            grams = batch.column("grams").to_numpy()
            likely = np.array(batch.column("likely").to_pylist()).reshape(n, size)
            said = [trust.get(d, np.zeros(size)) if d is not None else np.zeros(size) for d in batch.column("_declared").to_pylist()]
            log = np.log(prior) + np.array(said).reshape(n, size) + TRUST * likely
            log -= log.max(1, keepdims=True) if n else 0
            p = np.exp(log)
            p /= p.sum(1, keepdims=True)
            best = p.argmax(1)
            lang = [names[b] if g else UNDETERMINED for b, g in zip(best.tolist(), grams.tolist())]
            confidence = p[np.arange(n), best]
            unknown = [d if d and g and d not in modelled else None for d, g in zip(batch.column("_low").to_pylist(), grams.tolist())]
            lang = [d if d and (x == UNDETERMINED or c < KEEP) else x for x, c, d in zip(lang, confidence.tolist(), unknown)]
            keep = [x != UNDETERMINED and (c >= KEEP or x == d) and (chosen is None or x in chosen) for x, c, d in zip(lang, confidence.tolist(), unknown)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(lang, pa.string()), pa.array(confidence), batch.column("declared"), pa.array(keep, pa.bool_())],
                ["id", "lang", "confidence", "declared", "keep"])

    id_type = rows.schema["id"].dataType.simpleString()
    return levels.mapInArrow(tidy(fuse), f"id {id_type}, lang string, confidence double, declared string, keep boolean")


def _given(counts: dict[str, np.ndarray], size: int) -> dict[str, np.ndarray]:
    """Log probability of each declaration given the language of the text."""
    if not counts:
        return {}
    total = sum(counts.values()) + 1.0 * len(counts)
    return {d: np.log((n + 1.0) / total) for d, n in counts.items()}


def page_text(html_col: str = "html") -> F.Column:
    """A page without scripts, styles and markup."""
    bare = F.regexp_replace(html_col, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return F.regexp_replace(bare, r"&#?\w+;", " ")


def page_declares(html_col: str = "html") -> F.Column:
    """The language an html tag declares, null without one."""
    return F.nullif(F.regexp_extract(html_col, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]+)""", 1), F.lit(""))


def keep_identified(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared_col: str | None = "lang",
                    host_col: str | None = "source", languages: list[str] | None = None) -> DataFrame:
    """The rows of ``df`` without those whose language is rejected, columns unchanged.

    Decisions are made per id: of rows that share an id, all stay if one is kept. The rejected
    ids are the small side of the join; Spark broadcasts them only if they are few.
    """
    judged = identify(df, id_col, text_col, declared_col, host_col, languages=languages)
    name = unused(df, "_gone")
    gone = judged.groupBy(F.col("id").alias(name)).agg(F.max("keep").alias("keep")).where("not keep").select(name)
    return df.join(gone, F.col(id_col).eqNullSafe(F.col(name)), "left_anti")
