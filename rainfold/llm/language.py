"""Language identification by compression with per-language dictionaries.

Each language has a raw-content zstandard dictionary: the plain text of its
training documents.  A text is encoded with every dictionary; the smallest
frame names the language, and the score is the distance to the runner-up.

Fit: up to ``DICT_BYTES`` bytes a language, from the training documents with
the smallest seeded hashes, up to ``PART_CHARS`` characters of each (documented
bounds of the training sample; every text is then encoded whole).

Edge cases: a null text, or one without a letter, is ``und`` with score 0; so is
every text if no language could be learned; null languages are not learned; ties go
to the language that is first by code point; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_package, texts, utf8

DICT_BYTES = 96 << 10
PART_CHARS = 1000
#: Rows a language that may reach the driver: several times what fills its dictionary.
SAMPLE_ROWS = 600
LEVEL = 3
#: A margin below this share of the smallest frame marks the answer as rejected.
NARROW = 0.01
SEED = 6

LETTER = re.compile(r"[^\W\d_]")
_NOT_LETTERS = bytes(c for c in range(33, 128) if not chr(c).isalpha())
_TO_SPACE = bytes(32 if c in _NOT_LETTERS else c for c in range(256))


def plain(text: str) -> bytes:
    """Lower-case letters and spaces: what all dictionaries and texts are made of."""
    return b" ".join(text.lower().encode().translate(_TO_SPACE).split())


def learn(df: DataFrame, train: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Language to dictionary content, from rows where ``train`` holds."""
    rows = df.where(train & F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}  # a row a language
    if not counts:
        return {}
    share = F.element_at(F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, SAMPLE_ROWS / n)))]), F.col(lang))
    draw = F.pmod(F.xxhash64(F.lit(SEED), F.col(key)), F.lit(1 << 30))
    sample = rows.where(draw < share * (1 << 30)).select(F.col(lang).alias("lang"), draw.alias("draw"), F.substring(text, 1, PART_CHARS).alias("text"))
    out: dict[str, list[bytes]] = {k: [] for k in counts}
    for r in sorted(sample.collect(), key=lambda r: (r["draw"], r["text"])):
        if LETTER.search(r["text"]) and sum(map(len, out[r["lang"]])) < DICT_BYTES:
            out[r["lang"]].append(plain(r["text"]))
    return {k: b" ".join(v)[:DICT_BYTES] for k, v in sorted(out.items()) if v}


def margin_score(sizes: list[int], sharp: float = 40.0) -> float:
    """Probability-like score of the smallest size against the others."""
    least = min(sizes)
    return 1 / sum(math.exp(-sharp * (s - least) / least) for s in sizes)


def identify(df: DataFrame, dictionaries: dict[str, bytes], key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected (the margin is narrow)."""
    langs = sorted(dictionaries)

    def run(batches):
        import pyarrow as pa
        import zstandard as Z

        made = [Z.ZstdCompressor(level=LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
                for d in (Z.ZstdCompressionDict(dictionaries[k], dict_type=Z.DICT_TYPE_RAWCONTENT) for k in langs)]
        for c in made:
            c.compress(b"")
        for rows in texts(batches):
            out = []
            for k, raw in rows:
                body = raw.decode()
                if not langs or not LETTER.search(body):
                    out.append((k, "und", 0.0, True))
                    continue
                body = plain(body)
                sizes = [len(c.compress(body)) for c in made]
                best = min(range(len(sizes)), key=sizes.__getitem__)
                rest = min((s for i, s in enumerate(sizes) if i != best), default=2 * sizes[best])
                out.append((k, langs[best], margin_score(sizes), rest - sizes[best] < NARROW * sizes[best]))
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], keys), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"])

    from pyspark.sql.pandas.types import to_arrow_type

    ship_package(df.sparkSession)
    rows = df.select(F.col(key).alias("doc_id"), utf8(text).alias("text"))
    kind = rows.schema["doc_id"].dataType
    keys = to_arrow_type(kind)
    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, lang_pred string, score double, rejected boolean")
