"""Language identification by compression.

Each language gets a zstandard raw-content dictionary: a bounded sample of its
labelled texts, in lower case, without lines that other languages' samples
hold as well. The whole text is compressed with every dictionary, a long one in
blocks that the dictionary serves afresh: it saves a bounded number of bytes a
block, so the margin does not fall with the length. The language whose
dictionary gives the fewest bytes in all wins, the more frequent one at a tie.
The margin is how much smaller the best size is than the second best. A close
result is decided by a second, finer compression level; a margin that is still
narrow rejects the text.
"""

from __future__ import annotations

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runway.llm.bpe import slices
from runway.llm.common import crc_mod, giving_back, small_batches

UNKNOWN = "und"
SAMPLE_DOCS = 400  # labelled documents a language
DOC_CHARS = 400  # characters that each of them gives to the dictionary, at a place drawn by its id
BLOCK = 1 << 16  # bytes of a text that are compressed at once, at most
LEVEL = 3
CLOSE = 0.05  # below this margin the finer level decides
FINE_LEVEL = 12
MARGIN = 0.005  # a margin below this share rejects

Model = dict[str, bytes]  # by falling frequency of the language


def _content(samples: dict[str, list[str]]) -> Model:
    """Dictionary content: lower case, without lines that several languages share."""
    holders: dict[str, set[str]] = {}
    for lang, texts in samples.items():
        for line in (x for t in texts for x in t.split("\n")):
            holders.setdefault(line, set()).add(lang)
    content = {lang: "\n".join("\n".join(x for x in t.split("\n") if len(holders[x]) == 1) for t in texts)
               for lang, texts in samples.items()}
    # shorter than the least raw-content dictionary: no language can be learned from it
    return {lang: c.encode("utf-8", "replace") for lang, c in content.items() if len(c.encode("utf-8", "replace")) >= 8}


def fit(docs: DataFrame, held_out_mod: int = 5, sample_docs: int = SAMPLE_DOCS) -> Model:
    """A dictionary for each learned language, from labelled rows outside the
    held-out fold. Rows are drawn by hash of the id, at a rate that gives about
    ``sample_docs`` a language; the bound holds whatever the input's size."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    rows = rows.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").where(
        crc_mod(F.col("doc_id"), held_out_mod) != 0)
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    draw = (F.xxhash64("doc_id") / F.lit(2.0 ** 64)) + F.lit(0.5)
    rate = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 2 * sample_docs / n))])
    # a place anywhere in the text: openings (licences, headers, quotations) are no sample of it
    places = F.greatest(F.length("text") - DOC_CHARS + 1, F.lit(1))
    at = (F.pmod(F.xxhash64("doc_id", F.lit("place")), places) + 1).cast("int")
    drawn = rows.where(draw < rate[F.col("lang")]).select(
        "lang", draw.alias("draw"), "doc_id", F.substring("text", at, F.lit(DOC_CHARS)).alias("text")).collect()
    samples = {}
    for lang in sorted(counts, key=lambda x: (-counts[x], x)):
        own = sorted((r["draw"], r["doc_id"], r["text"]) for r in drawn if r["lang"] == lang)[:sample_docs]
        samples[lang] = [t.lower() for _, _, t in own]
    return _content(samples)


class Compressors:
    """One prepared compressor a language."""

    def __init__(self, model: Model):
        self.langs = list(model)
        self.plain = [self._prepare(c, LEVEL) for c in model.values()]
        self.fine = [self._prepare(c, FINE_LEVEL) for c in model.values()]

    @staticmethod
    def _prepare(content: bytes, level: int) -> zstandard.ZstdCompressor:
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=level)
        return zstandard.ZstdCompressor(dict_data=dictionary, write_checksum=False, write_content_size=False,
                                        write_dict_id=False)

    @staticmethod
    def _best(raw: bytes, tools: list[zstandard.ZstdCompressor]) -> tuple[int, float]:
        # blocks of equal length: no short one at the end
        step = -(-len(raw) // -(-len(raw) // BLOCK))
        view = memoryview(raw)
        sizes = [sum(len(t.compress(view[i:i + step])) for i in range(0, len(raw), step)) for t in tools]
        best = sizes.index(min(sizes))
        if len(sizes) == 1:
            return best, 1.0
        second = min(x for i, x in enumerate(sizes) if i != best)
        return best, (second - sizes[best]) / second

    def classify(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected) of a whole text."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        raw = (" " + text.lower() + "\n").encode("utf-8", "replace")
        best, margin = self._best(raw, self.plain)
        if margin < CLOSE:
            best, margin = self._best(raw, self.fine)
        return self.langs[best], margin, margin < MARGIN


def predict(docs: DataFrame, model: Model, held_out_mod: int = 5, keep: list[str] | None = None) -> DataFrame:
    """Language of every whole text: doc_id, held_out, lang_pred, score, rejected.

    ``und`` with score 0 for a null text, a text without a letter, or a model
    without languages. The score is the margin, from 0 (a tie) to 1. A null
    doc_id is kept and not held out; other columns are ignored. ``keep`` names
    input columns to hand through unchanged (after the five).
    """
    keep = keep or []
    held = F.coalesce(crc_mod(F.col("doc_id").cast("long"), held_out_mod) == 0, F.lit(False))
    # a text that is handed through is sent once
    text = [] if "text" in keep else [F.col("text").cast("string").alias("_text")]
    at = 2 + keep.index("text") if "text" in keep else 2 + len(keep)
    source = small_batches(docs).select(F.col("doc_id").cast("long").alias("_id"), held.alias("_held"),
                         *[F.col(f"`{c}`").alias(f"kept_{c}") for c in keep], *text)
    schema = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean" + "".join(
        f", `kept_{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches):
        tools = Compressors(model)
        for batch in batches:
            done = 0
            # results leave in slices: what a task holds besides the batch is bounded
            for texts in slices(batch.column(at).to_pylist()):
                b = batch.slice(done, len(texts))
                done += len(texts)
                out = [tools.classify(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array([x[0] for x in out], pa.string()),
                     pa.array([x[1] for x in out], pa.float64()), pa.array([x[2] for x in out], pa.bool_())]
                    + [b.column(2 + k) for k in range(len(keep))],
                    names=["doc_id", "held_out", "lang_pred", "score", "rejected", *[f"kept_{c}" for c in keep]])

    return source.mapInArrow(giving_back(run), schema)
