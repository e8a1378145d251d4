"""Language identification by fusing evidence.

The posterior of a language is proportional to
    P(text | language) ** weight * P(declared | language) * P(suffix | language) * P(language | host)

* text: trigrams of bytes under a model per declared code, fitted on a sample that grows with the
  number of codes only, plus a flat model for what is no language at all;
* declared: the markup's or table's own language code, trusted to a fixed degree;
* suffix: the last label of the address, where it names a country with one main language;
* host: how often each language is best by text among the documents of the host, smoothed towards
  its domain, that towards its suffix, that towards the whole corpus. These counts cover all rows.

A document without letters, or whose trigrams are less likely than the flat model in all that was
sampled, declared or not, is ``junk`` and undetermined. What no model covers is not junk: trigrams of
a script that was not sampled count neither way, and a sample too small to judge by rejects nothing.
Such a document gets the language its code, suffix or host names, also one without a text model, and
is undetermined without any. Null evidence says nothing; null hosts share one prior. Repeated rows
and null ids are handled row by row. An empty table gives no rows. All columns are carried, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotlake.llm.common import map_arrow, raw_texts, slices, staged

UNDETERMINED = "und"
# The sample for the text model: documents per declared code and bytes of each. Those without a code
# may be in many languages and count for so many codes.
SAMPLE_DOCUMENTS = 400
SAMPLE_BYTES = 4_000
UNDECLARED = 16

# Cells of ASCII trigrams, and of all others behind them.
CELLS = 1 << 15
FOREIGN = 1 << 18
# Codes with fewer sampled trigrams are taken together where junk is judged; a sample with fewer
# trigrams than the last number judges none.
SMALL = 5_000
JUDGED = 10_000
# A language knows a text whose trigrams it finds likelier than unseen ones by so much on average.
KNOWN = 1.0
# Text scored at once: every byte of it takes some fifty bytes of arrays.
SCORED_BYTES = 1 << 20
# What a language's trigrams give to all cells: one it has not seen weighs the same in every language.
BACK_OFF = 0.02
# Trigrams of a text are not independent; each counts for this share of an observation.
TEXT_WEIGHT = 0.2
DECLARED_TRUST = 0.9
SUFFIX_TRUST = 0.8
# A host's prior takes the weight of so many documents from the level above.
SMOOTHING = 20.0

# Country suffixes with one main language.
SUFFIXES = {
    "de": "de",
    "at": "de",
    "fr": "fr",
    "es": "es",
    "mx": "es",
    "ar": "es",
    "uk": "en",
    "us": "en",
    "au": "en",
    "ie": "en",
    "it": "it",
    "pt": "pt",
    "br": "pt",
    "nl": "nl",
    "pl": "pl",
    "se": "sv",
    "ru": "ru",
    "jp": "ja",
    "cn": "zh",
    "kr": "ko",
}

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 32


def trigram_cells(bounds: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell of every trigram that holds a letter, and its text; runs of non-letters are one space."""
    folded = _FOLD[data[bounds[0] : bounds[-1]]]
    texts = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    space = folded == 32
    keep = np.ones(len(folded), bool)
    keep[1:] = ~(space[1:] & space[:-1] & (texts[1:] == texts[:-1]))
    folded, texts = folded[keep].astype(np.uint32), texts[keep]
    if len(folded) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (folded[:-2] << 16) | (folded[1:-1] << 8) | folded[2:]
    inside = texts[:-2] == texts[2:]
    mixed = code * np.uint32(2654435761)
    foreign = (code & np.uint32(0x808080)) > 0
    cells = np.where(foreign, (mixed >> np.uint32(14)) + np.uint32(CELLS), mixed >> np.uint32(17)).astype(np.int64)
    return cells[inside], texts[:-2][inside]


def has_letters(bounds: np.ndarray, data: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(_FOLD[data[bounds[0] : bounds[-1]]] != 32)])
    return np.diff(sums[bounds - bounds[0]]) > 0


@dataclass(frozen=True)
class TextModel:
    """Seen cells of every language and what they gain over unseen ones; the flat model and the best language's.

    A text is in some language if its trigrams, each in the language that knows it best, are likelier
    than under the flat model; so a text in two languages is not rejected.
    """

    languages: tuple[str, ...]
    cells: tuple[np.ndarray, ...]
    gains: tuple[np.ndarray, ...]
    flat: float
    best: np.ndarray
    judges: bool

    floor = float(np.log(BACK_OFF / CELLS))

    def score(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log likelihood of each text under each model, its number of trigrams, and whether it has letters."""
        bounds, data = raw_texts(column)
        cells, texts = trigram_cells(bounds, data)
        rows = len(column)
        total = lambda weights: np.bincount(texts, weights=weights, minlength=rows).astype(np.float64)
        counts = np.bincount(texts, minlength=rows)
        unseen = self.floor * counts
        gain, scores = np.zeros(CELLS + FOREIGN), []
        for own, gains in zip(self.cells, self.gains, strict=True):
            gain[own] = gains
            scores.append(unseen + total(gain[cells]))
            gain[own] = 0.0
        flat = self.flat * counts
        # No model covers the script of a text most of whose foreign trigrams nobody has seen.
        best, foreign = self.best[cells], cells >= CELLS
        strange = 2 * total(foreign & (best <= self.floor)) > total(foreign)
        best = np.where(foreign & strange[texts], self.flat + 0.01, best)
        scores += [flat, total(best) if self.judges else flat + 1.0]
        return np.stack(scores, axis=1), counts, has_letters(bounds, data)


_CELL_COUNTS = T.StructType(
    [T.StructField("code", T.StringType()), *(T.StructField(c, T.LongType()) for c in ("cell", "n", "texts"))]
)


def _cell_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """code, cell, its trigrams and the texts that hold it."""
    for batch in slices(batches, "start", SCORED_BYTES):
        cells, texts = trigram_cells(*raw_texts(batch.column("start")))
        codes = batch.column("code").dictionary_encode()
        code = codes.indices.to_numpy().astype(np.int64)
        held, times = np.unique(texts * (CELLS + FOREIGN) + cells, return_counts=True)
        keys = code[held // (CELLS + FOREIGN)] * (CELLS + FOREIGN) + held % (CELLS + FOREIGN)
        found, place, n = np.unique(keys, return_inverse=True, return_counts=True)
        columns = [
            codes.dictionary.take(pa.array(found // (CELLS + FOREIGN))),
            pa.array(found % (CELLS + FOREIGN)),
            pa.array(np.bincount(place, weights=times, minlength=len(found)).astype(np.int64)),
            pa.array(n.astype(np.int64)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=_CELL_COUNTS.names)


def fit(docs: DataFrame, declared: Column, documents: int = SAMPLE_DOCUMENTS, size: int = SAMPLE_BYTES) -> TextModel:
    """A text model of every declared code, from about ``documents`` distinct texts of each and some without a code.

    One pass counts the codes, one takes the texts whose hash falls below the code's share and counts
    their trigrams where they are; only counts reach the driver.
    """
    code = F.coalesce(F.when(declared != UNDETERMINED, declared), F.lit(""))
    rows = docs.select(code.alias("code"), F.col("text").cast("string").alias("text")).where(F.length("text") > 0)
    times = rows.groupBy("code").count().collect()
    wanted = [(r[0], 1.5 * documents * (1 if r[0] else UNDECLARED) / r[1]) for r in times]
    shares = docs.sparkSession.createDataFrame(wanted, "code string, share double")
    hashed = rows.select("code", F.xxhash64("text").alias("h"), F.substring("text", 1, size).alias("start"))
    place = F.pmod("h", F.lit(1 << 30)) / float(1 << 30)
    chosen = hashed.join(F.broadcast(shares), "code").where(place < F.col("share"))
    chosen = chosen.groupBy("code", "h").agg(F.min("start").alias("start")).select("code", "start")
    counted = map_arrow(chosen, _cell_counts, _CELL_COUNTS).groupBy("code", "cell").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
    table = counted.toArrow()
    names, cell, n, texts = (table.column(c).combine_chunks() for c in ("code", "cell", "n", "texts"))
    cell, n, texts = cell.to_numpy(), n.to_numpy().astype(np.float64), texts.to_numpy()
    codes = sorted(set(pc.unique(names).to_pylist()))
    which = pc.index_in(names, pa.array(codes, pa.string())).to_numpy().astype(np.int64)
    order = np.lexsort((cell, which))
    which, cell, n, texts = which[order], cell[order], n[order], texts[order]
    sums = np.bincount(which, weights=n, minlength=len(codes)).astype(np.float64)
    # However small its sample, no language lifts the trigrams it has not seen.
    gains = np.log((1 - BACK_OFF) * n / sums[which] + BACK_OFF / CELLS) - TextModel.floor
    edges = np.searchsorted(which, np.arange(len(codes) + 1))
    taught = [k for k, c in enumerate(codes) if c]
    # What a single text holds may be junk itself. Small samples are taken together: many of them, each
    # with a few cells that weigh much, would lift all.
    held = np.bincount(cell, weights=texts, minlength=CELLS + FOREIGN) > 1
    best = np.full(CELLS + FOREIGN, BACK_OFF / CELLS)
    small = sums < SMALL
    for k in np.flatnonzero(~small):
        own = slice(edges[k], edges[k + 1])
        best[cell[own]] = np.maximum(best[cell[own]], n[own] / (sums[k] + 0.5 * CELLS))
    rest = np.bincount(cell[small[which]], weights=n[small[which]], minlength=CELLS + FOREIGN)
    best = np.maximum(best, rest / (rest.sum() + 0.5 * CELLS))
    # Letters at random would hit the cells of all languages' trigrams about evenly.
    flat = -np.log(min(max(len(np.unique(cell)), 256), CELLS)) - 2.0
    return TextModel(
        tuple(codes[k] for k in taught),
        tuple(cell[edges[k] : edges[k + 1]] for k in taught),
        tuple(gains[edges[k] : edges[k + 1]] for k in taught),
        float(flat),
        np.where(held, np.log(best), TextModel.floor),
        bool(n.sum() >= JUDGED),
    )


def address(url: Column) -> dict[str, Column]:
    """host, domain (its last two labels) and suffix of an address."""
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return {"host": host, "domain": F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), "suffix": F.regexp_extract(host, r"([^.]+)$", 1)}


def _scored(rows: DataFrame, model: TextModel, carry: T.StructType | None) -> DataFrame:
    """evidence, logs, grams and letters of every row, and the carried columns as ``row``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    fields = [] if carry is None else [T.StructField("row", carry)]
    fields += [
        rows.schema["evidence"],
        T.StructField("logs", T.ArrayType(T.DoubleType())),
        T.StructField("grams", T.LongType()),
        T.StructField("letters", T.BooleanType()),
    ]
    names, carried = [f.name for f in fields], None if carry is None else carry.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, lambda b: pc.struct_field(b.column("row"), "text"), SCORED_BYTES):
            whole = batch.column("row")
            scores, counts, letters = shared.value.score(pc.struct_field(whole, "text"))
            bounds = pa.array(np.arange(len(scores) + 1) * scores.shape[1], pa.int32())
            columns = [
                batch.column("evidence"),
                pa.ListArray.from_arrays(bounds, pa.array(scores.reshape(-1))),
                pa.array(counts, pa.int64()),
                pa.array(letters),
            ]
            if carried is not None:
                columns.insert(0, pa.StructArray.from_arrays([pc.struct_field(whole, c) for c in carried], names=carried))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_arrow(rows, run, T.StructType(fields))


def _in_no_language() -> Column:
    rejected = (F.col("grams") > 0) & (F.element_at("logs", -2) >= F.element_at("logs", -1))
    return ~F.col("letters") | rejected


def _known(taught: int) -> Column:
    """Whether any of the languages with a text model knows the text."""
    best = F.array_max(F.slice("logs", 1, taught))
    return F.coalesce(best - TextModel.floor * F.col("grams") > KNOWN * F.col("grams"), F.lit(False))


def _of_suffix() -> Column:
    pairs = F.create_map(*(F.lit(x) for pair in SUFFIXES.items() for x in pair))
    return F.coalesce(F.element_at(pairs, F.col("evidence.suffix")), F.lit(""))


def host_priors(scored: DataFrame, languages: tuple[str, ...], untaught: tuple[str, ...] = ()) -> DataFrame:
    """host, domain, suffix and the smoothed log prior of every language, from counts over all rows.

    A text that none of ``languages`` knows counts for the language its code or suffix names; the priors of
    ``untaught`` languages follow the others. Rows are reduced to one count per host and language before
    anything is joined.
    """
    names = F.array(*map(F.lit, (*languages, *untaught)))
    taught, width = len(languages), len(languages) + len(untaught)
    of_text = F.array_position("logs", F.array_max(F.slice("logs", 1, taught)))
    said = [F.col("evidence.declared")] if "declared" in scored.schema["evidence"].dataType.names else []
    said = [F.nullif(F.array_position(names, c), F.lit(0)) for c in (*said, _of_suffix())]
    best = F.when(_known(taught), of_text).otherwise(F.coalesce(*said))
    where = F.struct(*(F.coalesce(F.col(f"evidence.{c}"), F.lit("")).alias(c) for c in ("host", "domain", "suffix")))
    # Texts in no language say nothing of the host.
    told = scored.where(~_in_no_language()).select(where.alias("at"), best.alias("best")).where("best IS NOT NULL")
    per_host = told.groupBy("at", "best").agg(F.count("*").alias("n"))
    per_host = staged(per_host.select("at.*", "best", "n"), "hosts")

    def level(*keys: str) -> DataFrame:
        summed = per_host.groupBy(*keys, "best").agg(F.sum("n").cast("double").alias("n"))
        listed = summed.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias("n"))
        places = F.sequence(F.lit(1), F.lit(width)).cast("array<bigint>")
        return listed.select(*keys, F.transform(places, lambda k: F.coalesce(F.element_at("n", k), F.lit(0.0))).alias("counts"))

    def smooth(counts: Column, above: Column) -> Column:
        total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
        return F.zip_with(counts, above, lambda c, p: (c + SMOOTHING * p) / (total + SMOOTHING))

    top = {r.best: r.n for r in per_host.groupBy("best").agg(F.sum("n").alias("n")).collect()}
    every = sum(top.values()) + SMOOTHING
    p0 = F.array(*(F.lit((top.get(k + 1, 0) + SMOOTHING / width) / every) for k in range(width)))
    suffix = level("suffix").select("suffix", smooth(F.col("counts"), p0).alias("p1"))
    domain = level("suffix", "domain").join(suffix, "suffix").select("suffix", "domain", smooth(F.col("counts"), F.col("p1")).alias("p2"))
    host = level("suffix", "domain", "host").join(domain, ["suffix", "domain"])
    priors = host.select("suffix", "domain", "host", smooth(F.col("counts"), F.col("p2")).alias("prior"))
    return staged(priors.select("suffix", "domain", "host", F.transform("prior", lambda p: F.log(p)).alias("prior")), "priors")


def identify(
    docs: DataFrame,
    declared: Column,
    host: Column | None = None,
    domain: Column | None = None,
    suffix: Column | None = None,
    model: TextModel | None = None,
    carry: list[str] | None = None,
) -> DataFrame:
    """``row`` (the carried columns), language, posterior, text_language and junk of every document."""
    nothing = F.lit(None).cast("string")
    code = F.lower(F.regexp_extract(F.coalesce(declared.cast("string"), F.lit("")), r"^\s*([A-Za-z]{2,3})", 1))
    parts = {"declared": code, "host": host, "domain": domain, "suffix": suffix}
    evidence = F.struct(*((nothing if c is None else c.cast("string")).alias(n) for n, c in parts.items()))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), evidence.alias("evidence"))
    model = model or fit(docs.select("text", F.when(code != "", code).alias("code")), F.col("code"))
    carried = T.StructType([docs.schema[c] for c in (docs.columns if carry is None else carry)])
    taught = len(model.languages)
    untaught = tuple(sorted({*SUFFIXES.values()} - {*model.languages}))
    width = taught + len(untaught)
    scored = _scored(rows, model, carried)
    # Scored twice rather than stored: the texts would be written for the sake of a few numbers.
    priors = host_priors(_scored(rows, model, None), model.languages, untaught)
    keys = ["suffix", "domain", "host"]
    placed = scored.select("*", *(F.coalesce(F.col(f"evidence.{k}"), F.lit("")).alias(f"__{k}") for k in keys))
    joined = placed.join(priors.select(*(F.col(k).alias(f"__{k}") for k in keys), "prior"), [f"__{k}" for k in keys], "left")
    names = F.array(*map(F.lit, (*model.languages, *untaught)))
    even, never = float(-np.log(width)), -1e300
    said = F.when(F.col("evidence.declared") != UNDETERMINED, F.col("evidence.declared"))
    told_of = joined.select(
        "row",
        "logs",
        "grams",
        F.coalesce("prior", F.transform(names, lambda n: F.lit(even))).alias("prior"),
        F.coalesce(said, F.lit("")).alias("declared"),
        _of_suffix().alias("of_suffix"),
        _known(taught).alias("known"),
        _in_no_language().alias("junk"),
    )
    # A code without a text model is a candidate of its own row.
    own = (F.col("declared") != "") & ~F.array_contains(names, F.col("declared"))
    told_of = told_of.withColumn("own", own)

    def told(what: str, trust: float) -> Column:
        """Log of P(code | language) for each language."""
        other = float(np.log(max((1 - trust) / max(width - 1, 1), 1e-6)))
        return F.transform(names, lambda n: F.when(F.col(what) == "", 0.0).when(n == F.col(what), float(np.log(trust))).otherwise(other))

    # Languages without a text model, where something names them, stand at the flat model.
    untold = F.element_at("logs", -2) * TEXT_WEIGHT
    named = F.transform(
        F.array(*map(F.lit, untaught)).cast("array<string>"),
        lambda n, i: F.when(
            n.isin(F.col("declared"), F.col("of_suffix")) | (F.get("prior", i + taught) > even + 1e-9), untold
        ).otherwise(never),
    )
    by_text = F.concat(F.transform(F.slice("logs", 1, taught), lambda x: x * TEXT_WEIGHT), named)
    sums = F.zip_with(
        F.zip_with(by_text, F.col("prior"), lambda a, b: a + b),
        F.zip_with(told("declared", DECLARED_TRUST), told("of_suffix", SUFFIX_TRUST), lambda a, b: a + b),
        lambda a, b: a + b,
    )
    alone = F.when(F.col("own"), untold + even + float(np.log(DECLARED_TRUST))).otherwise(never)
    texts = told_of.withColumn("sums", F.concat(sums, F.array(alone)))
    # A host alone names what no model knows only where it has a language without a model.
    by_host = F.exists(F.slice("prior", taught + 1, width - taught), lambda p: p > float(np.log(0.5)))
    open_ = F.col("junk") | ~(F.col("known") | (F.col("declared") != "") | (F.col("of_suffix") != "") | by_host)
    texts = texts.select("*", open_.alias("open"), F.array_max("sums").alias("top"))
    place = F.array_position("sums", F.col("top")).cast("int")
    language = F.when(F.col("open"), UNDETERMINED).otherwise(F.element_at(F.concat(names, F.array("declared")), place))
    share = 1.0 / F.aggregate(F.transform("sums", lambda x: F.exp(x - F.col("top"))), F.lit(0.0), lambda s, x: s + x)
    best = F.array_max(F.slice("logs", 1, taught))
    of_text = F.when(F.col("known") & ~F.col("junk"), F.element_at(names, F.array_position("logs", best).cast("int")))
    return texts.select(
        "row",
        language.alias("language"),
        F.when(F.col("open"), 1.0).otherwise(share).alias("posterior"),
        F.coalesce(of_text, F.lit(UNDETERMINED)).alias("text_language"),
        "junk",
    )
