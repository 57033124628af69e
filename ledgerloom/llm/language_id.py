"""Languages told by compression.

Each language has a dictionary of raw text, a bounded sample of its labelled documents. A
text is compressed with each of them by zstandard, and the language whose dictionary makes
it smallest is chosen. Texts are reduced to words first, and a long text is compressed in
blocks, so that the dictionary counts for all of it and not only for its beginning.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

from ledgerloom.llm.common import free_names, text_of, worker_tool

UNKNOWN = "und"
LEVEL = 12
BLOCK_BYTES = 1024
_RESULT = StructType().add("lang_pred", StringType()).add("score", DoubleType()).add("rejected", BooleanType())


@dataclass(frozen=True)
class LanguageModel:
    """A dictionary of raw text for each language, and how many rows it had in training."""

    dictionaries: dict[str, bytes]
    rows: dict[str, int]


def words_only(text: str) -> bytes:
    """Lower-case words with single blanks around them; empty if there is no letter."""
    words = re.sub(r"[\W\d_]+", " ", text.lower()).strip()
    return f" {words} ".encode() if any(map(str.isalpha, words)) else b""


def train_languages(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    id_column: str = "doc_id",
    sample_rows: int = 400,
    sample_chars: int = 1000,
    dictionary_bytes: int = 64_000,
) -> LanguageModel:
    """Dictionaries from at most ``sample_rows`` documents of each language.

    The sample is a hash range of the ids, the same on every run; of each sampled document
    the first ``sample_chars`` characters count. What reaches the driver is bounded by
    languages x sample_rows x sample_chars. Rows with a null language or text don't count.
    """
    labelled = docs.where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    rows = {r[0]: r[1] for r in labelled.groupBy(lang_column).count().collect()}
    if not rows:
        return LanguageModel({}, {})
    # Twice the rows, because some have no letters and the hash only shares out on average.
    most = F.lit(None).cast("double")
    for lang, n in rows.items():
        most = F.when(F.col(lang_column) == lang, F.lit(min(1.0, 2 * sample_rows / n))).otherwise(most)
    place = F.shiftrightunsigned(F.xxhash64(F.col(id_column), F.lit("lang")), 11) / float(1 << 53)
    sample = labelled.where(place < most).select(
        F.col(lang_column), place, F.substring(F.col(text_column), 1, sample_chars)
    )
    texts: dict[str, list[tuple[float, bytes]]] = {}
    for lang, at, text in sample.collect():
        if reduced := words_only(text):
            texts.setdefault(lang, []).append((at, reduced))
    dictionaries = {
        lang: b"".join(text for _, text in sorted(found)[:sample_rows])[:dictionary_bytes]
        for lang, found in sorted(texts.items())
    }
    return LanguageModel(dictionaries, {lang: rows[lang] for lang in dictionaries})


def _sizes(model: LanguageModel):
    """A function from a reduced text to its compressed size in each language."""
    import zstandard

    packers = []
    for raw in model.dictionaries.values():
        held = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=LEVEL)
        packers.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False).compress)

    def sizes(reduced: bytes) -> list[int]:
        step = -(-len(reduced) // max(1, round(len(reduced) / BLOCK_BYTES)))
        blocks = [reduced[i : i + step] for i in range(0, len(reduced), step)]
        return [sum(len(pack(b)) for b in blocks) for pack in packers]

    return sizes


def language_of(
    text: Column, model: LanguageModel, narrow: float = 0.01, least_bytes: int = 64
) -> Column:
    """A struct of ``lang_pred``, ``score`` and ``rejected`` for a text column."""
    names = list(model.dictionaries)
    usual = np.array([-model.rows[n] for n in names])
    digest = hashlib.sha256(repr(sorted(model.dictionaries.items())).encode()).hexdigest()

    @F.pandas_udf(_RESULT)
    def classify(texts: pd.Series) -> pd.DataFrame:
        sizes = worker_tool(("languages", digest), lambda: _sizes(model))
        out = []
        for text in texts:
            reduced = words_only(text)
            if not reduced or not names:
                out.append((UNKNOWN, 0.0, True))
                continue
            size = np.array(sizes(reduced))
            order = np.lexsort((usual, size))  # equal sizes: the more usual language
            margin = 1.0 if len(names) == 1 else 1 - size[order[0]] / size[order[1]]
            rejected = margin < narrow and len(reduced) >= least_bytes
            out.append((names[order[0]], float(1 - np.exp(-margin / 0.05)), rejected))
        return pd.DataFrame(out, columns=_RESULT.names)

    return classify(text)


def identify_languages(
    docs: DataFrame,
    model: LanguageModel,
    text_column: str = "text",
    narrow: float = 0.01,
    least_bytes: int = 64,
) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1, from the margin) and ``rejected``.

    ``margin`` is how much smaller the best size is than the second, as a share. A text is
    rejected if it has no letter (also null and empty ones, ``und`` with score 0), or if it
    has ``least_bytes`` of words or more and a margin below ``narrow``: too much text to be
    of one of the languages and look alike in two. A shorter text says too little for that;
    where sizes are equal it goes to the language with more training rows. Whole texts count.
    Only the text matters, so repeated rows agree. Columns called like new ones are replaced.
    """
    (found,) = free_names(docs, "_language")
    new = list(_RESULT.names)
    kept = [c for c in docs.columns if c.lower() not in new]
    named = docs.withColumn(found, language_of(text_of(text_column), model, narrow, least_bytes))
    return named.select(*kept, *[F.col(f"{found}.{c}").alias(c) for c in new])
