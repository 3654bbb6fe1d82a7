"""Language identification by compressed size.

Each language has a zstandard raw-content dictionary made of training text. A
text is cut into chunks; every chunk is compressed against every dictionary,
and the language with the smallest total wins. The margin is the share of bytes
that the winner saves over the runner-up; a narrow one is a rejection.

Training reads only rows with a language and a text. Of each language at most
``docs_per_lang`` documents, those with the smallest hash of their id and text,
give one piece of up to ``piece`` characters each, and the dictionary keeps the
first ``dict_bytes`` of them: a documented bound, whatever the table's size.

Defined cases: a text that is null or without a letter is ``und`` with score 0
and rejected; without any training language every row is; ties between sizes go
to the language that sorts first; repeated rows are judged alike; very long
texts are compressed whole, chunk by chunk; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LETTERS = regex.compile(r"\p{L}+")
#: Bytes a chunk: short enough that matches come from the dictionary, not from the text itself.
CHUNK = 512
LEVEL = 7
#: Share of bytes below which the two best languages count as undecided.
MARGIN = 0.004


def letters(text: str | None) -> bytes:
    """The runs of letters in lower case, joined by blanks; empty without any."""
    if not isinstance(text, str):
        return b""
    return " ".join(LETTERS.findall(text.lower())).encode("utf-8", "ignore")


def train(documents: DataFrame, chosen: Column, docs_per_lang: int = 400, piece: int = 2000, dict_bytes: int = 65536) -> dict[str, bytes]:
    """A dictionary's content for each language among the ``chosen`` rows."""
    rows = documents.where(chosen & F.col("lang").isNotNull() & (F.trim("text") != "")).select("doc_id", "lang", "text")
    rank = F.xxhash64("doc_id", "text")
    # A common language is thinned by the hash to about three times what is
    # picked, before its rows meet for the ranking.
    many = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    thin = F.lit(False)
    for lang, n in many.items():
        share = min(1.0, 3 * docs_per_lang / n)
        thin = thin | ((F.col("lang") == lang) & (F.shiftrightunsigned(rank, 11) < int(share * 2**53)))
    rows = rows.where(thin)
    begin = F.pmod(rank, F.greatest(F.length("text") - piece, F.lit(0)) + 1).cast("int") + 1
    pieces = rows.select("lang", rank.alias("rank"), F.substring(F.col("text"), begin, F.lit(piece)).alias("piece"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("rank", "piece"))
    picked = pieces.withColumn("n", first).where(F.col("n") <= docs_per_lang).select("lang", "n", "piece").collect()
    found: dict[str, list[tuple[int, str]]] = {}
    for r in picked:
        found.setdefault(r["lang"], []).append((r["n"], r["piece"]))
    contents = {}
    for lang, rows_of in sorted(found.items()):
        distinct = dict.fromkeys(text for _, text in sorted(rows_of))
        contents[lang] = b" ".join(letters(text) for text in distinct)[:dict_bytes]
    # Equal amounts of text, else a large dictionary wins by its size alone.
    least = min((len(c) for c in contents.values()), default=0)
    return {lang: c[: max(least, 4096)] for lang, c in contents.items()}


def sizes(data: bytes, models: list[zstandard.ZstdCompressor], chunk: int = CHUNK) -> np.ndarray:
    """Compressed bytes of the whole text under each language's dictionary."""
    parts = [data[i : i + chunk] for i in range(0, len(data), chunk)]
    return np.array([sum(len(m.compress(p)) for p in parts) for m in models], float)


def compressors(contents: dict[str, bytes]) -> list[zstandard.ZstdCompressor]:
    models = []
    for content in contents.values():
        shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        shared.precompute_compress(level=LEVEL)
        models.append(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=shared, write_checksum=False, write_content_size=False, write_dict_id=False
            )
        )
    return models


def identify(documents: DataFrame, contents: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """(doc_id, lang_pred, score, margin, rejected) of every row.

    The score is the winner's share when each language weighs two to the power
    of -64 times its relative excess over the smallest size, so that it depends
    on the margin and not on the text's length.
    """
    langs = list(contents)

    @F.pandas_udf("lang_pred string, score double, margin double, rejected boolean")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        models = compressors(contents)
        for batch in batches:
            out = []
            for text in batch:
                data = letters(text)
                if not data or not langs:
                    out.append(("und", 0.0, 0.0, True))
                    continue
                got = sizes(data, models)
                order = np.argsort(got, kind="stable")
                best = got[order[0]]
                gap = (got[order[1]] - best) / got[order[1]] if len(got) > 1 else 1.0
                saved = (got - best) / max(best, 1.0)
                score = 1.0 / float(np.sum(np.exp2(-saved * 64)))
                out.append((langs[order[0]], score, float(gap), len(got) > 1 and gap < margin))
            yield pd.DataFrame(out, columns=["lang_pred", "score", "margin", "rejected"])

    return documents.select("doc_id", judge("text").alias("judged")).select("doc_id", "judged.*")


def keep_identified(documents: DataFrame, contents: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """Documents whose text is not rejected, all columns as they were."""

    @F.pandas_udf("boolean")
    def accepted(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        models = compressors(contents)
        for batch in texts:
            out = []
            for text in batch:
                data = letters(text)
                if not data or not models:
                    out.append(False)
                    continue
                best, second = np.sort(np.append(sizes(data, models), np.inf))[:2]
                out.append(bool(not np.isfinite(second) or second - best >= margin * second))
            yield pd.Series(out, dtype=bool)

    return documents.where(accepted(F.col("text")))
