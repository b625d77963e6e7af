"""Language identification by compression with per-language dictionaries."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundsheet.llm.texts import filled, slices

UNKNOWN = "und"
#: Learning is bounded: so many documents per language, and one piece of so many characters of each.
DOCS, PIECE = 400, 240
#: A dictionary's bytes at most, the compression level, and the bytes compressed at a time.
DICTIONARY_BYTES, LEVEL, BLOCK = 64 << 10, 6, 2000
#: A text is rejected when the second-best language needs less than a learned share more, or under MIN_BYTES more.
#: The share is this quantile of what texts to learn from have, MARGIN at least.
QUANTILE, MARGIN, MIN_BYTES = 0.005, 0.001, 1
#: Accuracy of that quantile's sketch.
ACCURACY = 10_000


def fold(texts: pa.Array) -> pa.Array:
    """Lower case, every run of what is no letter as one space."""
    return pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}]+", " ")


def learn_dictionaries(documents: DataFrame, usable: Column) -> dict[str, bytes]:
    """Raw dictionary content per language, most common first, from rows where ``usable`` with text and lang.

    Counts cover all rows; DOCS documents per language are then drawn by a hash of their texts, so
    copies count once, and one piece of each is taken at a place given by the hash.  Every piece counts with an
    equal share of DICTIONARY_BYTES, cut between characters.
    """
    rows = documents.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 2 * DOCS / n))]), F.col("lang"))
    hashed = rows.select("lang", "text", F.xxhash64("text").alias("h"))
    drawn = hashed.where(F.pmod("h", F.lit(1_000_003)) < share * 1_000_003)
    start = (1 + F.pmod(F.floor(F.col("h") / 1024), F.greatest(F.length("text") - PIECE, F.lit(1)))).cast("int")
    pieces = drawn.select("lang", "h", F.substr("text", start, F.lit(PIECE)).alias("piece"))
    found: dict[str, list[tuple[int, str]]] = {}
    for r in pieces.groupBy("lang", "h").agg(F.min("piece").alias("piece")).collect():
        found.setdefault(r.lang, []).append((r.h, r.piece))
    learned = {}
    for lang, listed in sorted(found.items()):
        listed = sorted(listed)[:DOCS]
        share = DICTIONARY_BYTES // len(listed) - 1
        folded = fold(pa.array([p for _, p in listed], pa.string())).to_pylist()
        learned[lang] = " ".join(p.encode()[:share].decode(errors="ignore") for p in folded).encode()
    common = sorted(learned, key=lambda lang: (-counts[lang], lang))
    return {lang: learned[lang] for lang in common if learned[lang].strip()}


class Classifier:
    """Compressed sizes of a text under each language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes], margin: float = MARGIN):
        import zstandard

        self.languages, self.margin = list(dictionaries), margin
        self._press = []
        for lang in self.languages:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self._press.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False
            ).compress)

    def judge(self, folded: bytes) -> tuple[str, float, bool]:
        """Language, score and rejection of a folded text."""
        lang, score, gap, best = self.weigh(folded)
        return lang, score, gap < max(MIN_BYTES, self.margin * best)

    def weigh(self, folded: bytes) -> tuple[str, float, int, int]:
        """Language, score, bytes that the second-best needs more, and bytes of the best.

        The whole text counts, block by block, so that a long text keeps drawing on the dictionary
        instead of on itself.  The score is the share of the best language when every byte more
        halves a language's weight twice, on texts of 100 bytes as on long ones.
        """
        if not folded.strip() or not self.languages:
            return UNKNOWN, 0.0, 0, 0
        blocks = [folded[k : k + BLOCK] for k in range(0, len(folded), BLOCK)]
        sizes = [sum(len(press(block)) for block in blocks) for press in self._press]
        order = sorted(range(len(sizes)), key=lambda k: (sizes[k], k))
        best = sizes[order[0]]
        score = 1 / sum(math.exp((best - size) / (0.5 + 0.005 * best)) for size in sizes)
        gap = sizes[order[1]] - best if len(order) > 1 else best
        return self.languages[order[0]], score, gap, best


def learn_margin(documents: DataFrame, usable: Column, dictionaries: dict[str, bytes]) -> float:
    """QUANTILE of the share that the second-best language needs more, over all ``usable`` texts told rightly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(dictionaries)
        for batch in slices(batches):
            found = [classifier.weigh(t.encode()) for t in fold(filled(batch)).to_pylist()]
            right = [lang == told[0] for lang, told in zip(batch.column("lang").to_pylist(), found, strict=True)]
            yield pa.RecordBatch.from_pydict({"share": pa.array([gap / best for ok, (_, _, gap, best) in zip(right, found, strict=True) if ok], pa.float64())})

    rows = documents.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    shares = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(run, "share double")
    found = shares.agg(F.percentile_approx("share", F.lit(QUANTILE), F.lit(ACCURACY))).first()[0]
    return MARGIN if found is None else max(MARGIN, found)


def identify(documents: DataFrame, dictionaries: dict[str, bytes], keys: list[str], margin: float = MARGIN) -> DataFrame:
    """``keys``, lang_pred, score and rejected of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(dictionaries, margin)
        for batch in slices(batches):
            found = [classifier.judge(t.encode()) for t in fold(filled(batch)).to_pylist()]
            langs, scores, rejected = zip(*found, strict=True)
            columns = {k: batch.column(k) for k in keys}
            columns |= {"lang_pred": pa.array(langs), "score": pa.array(scores), "rejected": pa.array(rejected)}
            yield pa.RecordBatch.from_pydict(columns)

    kept = documents.select(*keys, F.col("text").cast("string").alias("text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.select(*keys).schema)
    return kept.mapInArrow(run, f"{fields}, lang_pred string, score double, rejected boolean")


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from; so is a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(True))


def language_id(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every row of ``documents``.

    Learned from text and non-null lang of rows that are not held out; a prediction reads the text
    alone.  ``lang_pred`` is the language whose dictionary gives the smallest output, the most
    common one on a tie; ``rejected`` says that the second-best is too close, or nothing could be told: closer than all but
    QUANTILE of the texts to learn from have it.
    Null texts and texts without a letter, and all texts if no language was learned, are ``und``
    with score 0 and rejected.  A null doc_id keeps its row; repeated rows are judged alike; an
    empty table gives no rows.  Other columns are not read.
    """
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    dictionaries = learn_dictionaries(docs, ~held_out(F.col("doc_id")))
    margin = learn_margin(docs, ~held_out(F.col("doc_id")), dictionaries)
    told = identify(docs, dictionaries, ["doc_id"], margin)
    return told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
