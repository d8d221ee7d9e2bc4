"""Operator 3: language by compression.

Each language has a raw-content zstandard dictionary made of text of that language.  A text is compressed,
block by block, with every dictionary; the language whose dictionary makes it smallest wins.  Where the
two smallest sizes are nearly equal the prediction is marked as rejected.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._words import in_batches

BLOCK = 32_768
DICTIONARY_BYTES = 64_000
SAMPLE_DOCUMENTS = 400
EXCERPT_CHARS = 200
LANGUAGES = 64
#: Matches of four bytes count: with longer ones, words of a few syllables find no match in the dictionary.
SETTINGS = dict(window_log=17, chain_log=15, hash_log=15, search_log=3, min_match=4, target_length=16, strategy=zstandard.STRATEGY_GREEDY)
NARROW = 0.002
UNKNOWN = "und"

_NO_WORDS = re.compile(r"[\W\d_]+")


def _letters(text: str) -> bytes:
    """The text's words of letters, lower-cased: junk between them tells no language.

    Fractions, circled and raised digits count as word characters without being letters, so words without a
    single letter go, too.
    """
    runs = _NO_WORDS.sub(" ", text.lower()).split()
    return " ".join(w if w.isalpha() else "".join(c for c in w if c.isalpha() or unicodedata.category(c)[0] == "M") for w in runs if not w.isdigit() and any(map(str.isalpha, w))).encode("utf-8", "replace")


def part_of(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def dictionaries(labelled: DataFrame, *, sample_documents: int = SAMPLE_DOCUMENTS, dictionary_bytes: int = DICTIONARY_BYTES, excerpt_chars: int = EXCERPT_CHARS, languages: int = LANGUAGES) -> dict[str, bytes]:
    """Dictionary content by language, from columns doc_id, text, lang.

    The fit knows the ``languages`` most frequent values of lang (ties by name) and takes about ``sample_documents``
    different rows of each (at most twice as many), chosen by a hash of id and text, and the middle
    ``excerpt_chars`` of each, in order of the hash until ``dictionary_bytes`` are full: documented bounds,
    whatever the table's size, each language by itself.  Copies of a row count once, rows without an id go by their text.
    Rows without a language, without text or without letters teach nothing.
    """
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages).collect()}
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, sample_documents / n))])
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003)) / 1_000_003.0
    start = F.greatest(F.lit(1), F.expr(f"cast(length(text) div 2 - {excerpt_chars // 2} as int)"))
    rows = known.where(draw <= F.try_element_at(share, F.col("lang"))).select("lang", draw.alias("draw"), F.substring("text", start, F.lit(excerpt_chars)).alias("text")).distinct()
    first = Window.partitionBy("lang").orderBy("draw", "text")
    found: dict[str, set[bytes]] = {}
    room = dict.fromkeys(counts, dictionary_bytes)
    for draw, lang, excerpt in sorted((r["draw"], r["lang"], _letters(r["text"])) for r in rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= 2 * sample_documents).collect()):
        own = found.setdefault(lang, set())
        if excerpt not in own and len(excerpt) < room[lang]:
            own.add(excerpt)
            room[lang] -= len(excerpt) + 1
    # What stands last in a raw dictionary is nearest, so it is sorted to be the same on every run.
    return {lang: b" ".join(sorted(excerpts)) for lang, excerpts in sorted(found.items())}


def _predictor(dicts: dict[str, bytes], narrow: float):
    made: list = []

    def predict(texts: pd.Series) -> pd.DataFrame:
        if not made:
            settings = zstandard.ZstdCompressionParameters(write_content_size=0, write_checksum=0, write_dict_id=0, **SETTINGS)
            for lang, content in dicts.items():
                shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                shared.precompute_compress(compression_params=settings)
                made.append((lang, zstandard.ZstdCompressor(dict_data=shared, compression_params=settings)))
        out = []
        for text in texts:
            raw = _letters(text) if isinstance(text, str) and made else b""
            if not raw:
                out.append((UNKNOWN, 0.0, 0.0, True))
                continue
            blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
            sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for lang, c in made)
            best = sizes[0][0]
            weight = [2.0 ** -min(60.0, (n - best) / (1.0 + 0.01 * best)) for n, _ in sizes]
            margin = (sizes[1][0] - best) / best if len(sizes) > 1 else 1.0
            out.append((sizes[0][1], 1.0 / sum(weight), margin, margin < narrow))
        return pd.DataFrame(out, columns=["lang", "score", "margin", "rejected"])

    return predict


def predicted(text: Column, dicts: dict[str, bytes], *, narrow: float = NARROW) -> Column:
    """struct<lang, score, margin, rejected> of a text.

    margin: how much larger the second smallest size is than the smallest, relative to it; rejected: margin
    under ``narrow``, or no language to tell (null text, no letters, nothing learned), which gives 'und'
    with score 0.  Ties go to the language first in order.  Very long texts are compressed whole, in blocks.
    """
    return F.pandas_udf(_predictor(dicts, narrow), "lang string, score double, margin double, rejected boolean")(text)


def report(documents: DataFrame) -> DataFrame:
    """The contract's rows: learned only where crc32(doc_id) mod 3 is not 1; a null id counts as the empty text there.

    Null, empty and letterless texts are ``und``; ties go to the language first in order; repeated rows are judged
    alike, each with a row of its own; very long texts count whole; other columns are not read; no rows give no rows.
    """
    held = part_of(F.col("doc_id"), 3) == 1
    dicts = dictionaries(documents.where(~held).select("doc_id", "text", "lang"))
    found = in_batches(documents).select("doc_id", held.alias("held_out"), predicted(F.col("text"), dicts).alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"), F.col("p.margin").alias("margin"), F.col("p.rejected").alias("rejected"))


def accepted(documents: DataFrame) -> DataFrame:
    """The rows whose language is told with a margin that is not narrow; all their columns as they were.

    Null, empty and letterless texts are rejected, and all rows where nothing can be learned; repeated rows are
    judged alike; no rows give no rows.  No column is added, so none can clash.
    """
    held = part_of(F.col("doc_id"), 3) == 1
    dicts = dictionaries(documents.where(~held).select("doc_id", "text", "lang"))
    return in_batches(documents).where(~predicted(F.col("text"), dicts)["rejected"])
