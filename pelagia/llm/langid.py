"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are added as log probabilities: the text under a character n-gram model of each language; the language
that the markup declares; the suffix of the address; and a prior for the host.  How far declarations and suffixes can be trusted
is counted over all pages (grouped sums of the text posteriors).  A host's prior is smoothed towards its domain's, and that
towards the whole table's, each by `strength` pseudo-pages; a page's own share is taken out of every count it meets, so it is
never evidence for itself.

The n-gram model is fitted on at most max_rows labelled documents (a documented bound), chosen by hash within each language:
rare languages give all they have and the others share the rest evenly.  Trigrams of one page hang together, so beyond some number they
tell no more: that number is fitted on a fifth of the sample, held out of a first model.  All counts over pages cover every page.  The
model is a table of languages x 2^BITS, the only thing broadcast; more than max_languages are an error.

Cases: null or empty markup leaves the text likelihood flat; a null or odd address has the host "" and suffix ""; rows that repeat
a page_id are pages of their own; of equally likely languages the first by name is told; pages of any length are read in one scan;
columns other than page_id, url and html are not read; without labelled documents the language is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pelagia.llm.common import Scratch, salted_lookup

BITS = 16
#: What `worth` is chosen from: beyond so many trigrams a page's count as if there were so many.
WORTHS = (10, 20, 40, 60, 90, 130, 200, 300, 500, 1000)

_HIDDEN = regex.compile(r"<(?:(!)--|(script|style|nav|head)\b)", regex.I)
_CLOSED = {"!": regex.compile("-->")} | {n: regex.compile(rf"</{n}\s*+>", regex.I) for n in ("script", "style", "nav", "head")}
_ENTITY = regex.compile(r"&#?\w{1,8};")


def visible_text(html: str | None) -> str:
    """The text between tags, without scripts, styles, navigation, head and comments; one scan forward, also where none of them ends."""
    html, at, out, open_ended = html or "", 0, [], set()
    while (tag := html.find("<", at)) >= 0:
        out.append(html[at:tag])
        hidden = _HIDDEN.match(html, tag)
        kind = (hidden[1] or hidden[2]).lower() if hidden else ""
        close = None
        if kind and kind not in open_ended:
            close = _CLOSED[kind].search(html, hidden.end())
            if close is None:
                open_ended.add(kind)  # nor does any later one end
        at = close.end() if close else html.find(">", tag) + 1
        if not at:
            at = tag
            break
    return _ENTITY.sub(" ", " ".join([*out, html[at:]]))


def grams(text: str) -> np.ndarray:
    """Hashed byte trigrams of the lower-cased words."""
    b = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64)
    h = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(0x9E3779B1)
    return (h >> np.uint32(32 - BITS)).astype(np.int64)


def quotas(sizes: dict[str, int], rows: int) -> dict[str, int]:
    """How many of each language's documents are taken: an even share, where what the smaller ones lack goes to the larger ones."""
    out = {}
    for i, (name, n) in enumerate(sorted(sizes.items(), key=lambda x: (x[1], x[0]))):
        out[name] = min(n, max(1, rows // (len(sizes) - i)))
        rows -= out[name]
    return out


@dataclass(frozen=True)
class Model:
    names: list[str]  # of the languages, sorted
    table: np.ndarray  # the log probability of every gram under each
    worth: int
    held_out: float | None = None  # accuracy of the text alone on the held-out documents, by a model without them


def _table(counts: np.ndarray) -> np.ndarray:
    counts = counts + 0.5
    return np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)


def fitted_worth(means: np.ndarray, sizes: np.ndarray, true: np.ndarray) -> int:
    """The number of WORTHS with the least log loss on documents with these mean log probabilities and numbers of grams."""

    def loss(worth: int) -> float:
        s = means * np.minimum(sizes, worth)[:, None]
        s = s - s.max(1, keepdims=True)
        return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(true)), true]).mean())

    return min(WORTHS, key=lambda w: (round(loss(w), 9), w))


def fit(docs: DataFrame, max_rows: int = 20_000, max_languages: int = 200) -> Model:
    """Languages, gram probabilities and worth; at most max_rows documents are read, each text of a doc_id once."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL")
    chosen = known.select("lang", "text", F.xxhash64(F.lit("lang"), "doc_id", "text").alias("order"))
    # Repeated rows have one hash; a count within 2 % will do for the cut below.
    sizes = {r["lang"]: r["n"] for r in chosen.groupBy("lang").agg(F.approx_count_distinct("order", 0.02).alias("n")).limit(max_languages + 1).collect()}
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages: raise max_languages, the model takes 2^{BITS} numbers for each")
    names = sorted(sizes)
    if not names:
        return Model([], np.zeros((0, 1 << BITS), np.float32), WORTHS[0])
    taken = quotas(sizes, max_rows)
    # A cut on the hash comes first, so that no task passes on more than its share.
    cut = {n: min(2**63 - 1, int(-(2**63) + min(1.0, 1.25 * taken[n] / sizes[n]) * 2**64)) for n in names}
    limits = F.broadcast(docs.sparkSession.createDataFrame([(n, taken[n], cut[n]) for n in names], "lang string, quota long, cut long"))
    near = chosen.select("lang", "order").join(limits, "lang").where("order <= cut").distinct()
    ids = near.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("order"))).where("rank <= quota").select("lang", "order")
    scratch = Scratch(docs.sparkSession)
    once = chosen.join(F.broadcast(ids), ["lang", "order"], "left_semi").groupBy("lang", "order").agg(F.min("text").alias("text"))
    rows = scratch.staged(once.select("lang", "text", (F.pmod(F.xxhash64(F.lit("held"), "order"), F.lit(5)) == 0).alias("held")), "language_sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, len(names), 1 << BITS), np.int64)
        at = {n: i for i, n in enumerate(names)}
        for b in batches:
            for lang, text, held in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                total[int(held), at[lang]] += np.bincount(grams(text), minlength=1 << BITS)
        held, lang, gram = np.nonzero(total)
        if len(lang):
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(lang, pa.int32()), pa.array(gram, pa.int32()), pa.array(total[held, lang, gram], pa.int64())], ["held", "l", "gram", "n"])

    # At most 2 x languages x 2^BITS rows.
    got = rows.mapInArrow(count, "held int, l int, gram int, n long").groupBy("held", "l", "gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((2, len(names), 1 << BITS))
    counts[got["held"], got["l"], got["gram"]] = got["n"]
    first = docs.sparkSession.sparkContext.broadcast(_table(counts[0]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = [grams(t) for t in b.column(1).to_pylist()]
            means = [first.value[:, g].mean(1, dtype=np.float64).tolist() if len(g) else [0.0] * len(names) for g in each]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(means, pa.list_(pa.float64())), pa.array([len(g) for g in each], pa.int64())], ["lang", "means", "size"])

    judged = rows.where("held").mapInArrow(judge, "lang string, means array<double>, size long").toPandas()  # about max_rows / 5
    scratch.close()
    if judged.empty:
        return Model(names, _table(counts.sum(0)), WORTHS[0])
    means, true = np.vstack(judged["means"]), np.array([names.index(x) for x in judged["lang"]])
    return Model(names, _table(counts.sum(0)), fitted_worth(means, judged["size"].to_numpy(), true), float((means.argmax(1) == true).mean()))


def _host(url: Column) -> Column:
    """The host of an address, without what names a user or a port."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:@\[\]]+)", 1), F.lit("")))


def evidence(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, host, domain, suffix, declared and text: log likelihoods of the visible text."""
    sent, names, worth = pages.sparkSession.sparkContext.broadcast(model.table), model.names, model.worth
    code = F.lower(F.regexp_extract(F.col("html"), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    parts = F.split(F.col("host"), r"\.")
    given = pages.select("page_id", "html", _host(F.col("url")).alias("host"), F.when(code.isin(names), code).when(code == "", "none").otherwise("other").alias("declared"))
    given = given.withColumns({"domain": F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), "."), "suffix": F.element_at(parts, -1)})
    given = given.withColumn("declared", F.coalesce("declared", F.lit("none")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for b in batches:
            out = np.zeros((b.num_rows, len(names)))
            for i, h in enumerate(b.column(1)):
                g = grams(visible_text(h.as_py()))
                if len(g):
                    out[i] = table[:, g].mean(1, dtype=np.float64) * min(len(g), worth)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1) * len(names), pa.int32()), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:], lists], ["page_id", "host", "declared", "domain", "suffix", "text"])

    return given.select("page_id", "html", "host", "declared", "domain", "suffix").mapInArrow(run, "page_id long, host string, declared string, domain string, suffix string, text array<double>")


def _softmax(x: Column) -> Column:
    e = F.transform(x, lambda v: F.exp(v - F.array_max(x)))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def identify(pages: DataFrame, docs: DataFrame, strength: float = 5.0) -> DataFrame:
    """page_id, lang, confidence, text_lang, declared and host for every page."""
    return fused(pages, fit(docs), strength)


def fused(pages: DataFrame, model: Model, strength: float = 5.0) -> DataFrame:
    """What identify() tells, by a model at hand."""
    names = model.names
    if not names:
        none = F.lit(None).cast("string")
        return pages.select("page_id", none.alias("lang"), F.lit(None).cast("double").alias("confidence"), none.alias("text_lang"), none.alias("declared"), _host(F.col("url")).alias("host"))
    n = len(names)
    base = Scratch(pages.sparkSession).staged(evidence(pages, model).withColumn("p", _softmax(F.col("text"))), "evidence", keep=True)
    sums = [F.sum(F.col("p")[i]).alias(f"s{i}") for i in range(n)]

    def counted(key: str) -> DataFrame:
        return base.groupBy(key).agg(F.array(*sums).alias(f"by_{key}"))

    whole = base.agg(F.array(*[F.coalesce(s, F.lit(0.0)) for s in [F.sum(F.col("p")[i]) for i in range(n)]]).alias("by_all"))
    rows = base.crossJoin(F.broadcast(whole))  # one row
    for key in ("host", "domain", "suffix", "declared"):
        rows = salted_lookup(rows, counted(key), [key])
    own = F.col("p")

    def without(name: str) -> Column:
        return F.zip_with(F.col(name), own, lambda a, b: F.greatest(a - b, F.lit(0.0)))

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda a, b: a + b)

    def smoothed(x: Column, prior: Column) -> Column:
        return F.zip_with(x, prior, lambda a, b: (a + strength * b) / (total(x) + strength))

    def given_language(x: Column, everyone: Column, kinds: int) -> Column:
        """P(this declaration or suffix | language): its share of the language's pages."""
        return F.zip_with(x, everyone, lambda a, b: (a + 1.0 / kinds) / (b + 1.0))

    rows = rows.withColumns({f"w_{k}": without(f"by_{k}") for k in ("all", "host", "domain", "suffix", "declared")})
    rows = rows.withColumn("prior_all", F.transform("w_all", lambda a: (a + 1.0) / (total(F.col("w_all")) + n)))
    rows = rows.withColumn("prior_domain", smoothed(F.col("w_domain"), F.col("prior_all")))
    rows = rows.withColumn("prior_host", smoothed(F.col("w_host"), F.col("prior_domain")))
    rows = rows.withColumns({"from_suffix": given_language(F.col("w_suffix"), F.col("w_all"), 20), "from_markup": given_language(F.col("w_declared"), F.col("w_all"), n + 2)})
    total_of = F.col("text")
    for part in ("prior_host", "from_suffix", "from_markup"):
        total_of = F.zip_with(total_of, F.col(part), lambda a, b: a + F.log(F.greatest(b, F.lit(1e-12))))
    rows = rows.withColumn("fused", total_of).withColumn("posterior", _softmax(F.col("fused")))
    label = F.array(*[F.lit(x) for x in names])

    def best(x: str) -> Column:
        return F.element_at(label, F.array_position(F.col(x), F.array_max(x)).cast("int"))

    return rows.select("page_id", best("posterior").alias("lang"), F.array_max("posterior").alias("confidence"), best("p").alias("text_lang"), "declared", "host")
