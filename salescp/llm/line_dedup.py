"""Line de-duplication over a corpus, with DataFrame operations only.

Lines are exploded with their position, normalised and hashed (128 bits); each
hash gets its number of distinct documents and the largest document id; lines
over the threshold go everywhere but there, and the remaining lines of each
document are joined in their order.

Scale.  Only (id, text hash, position, line hash) is shuffled for the counts,
never a line.  The distinct count shuffles by (line hash, document) first and
then one partial row per line hash and task, so a line that a third of all
documents hold is spread; its way back to the documents is a join that AQE may
split.  Nothing is broadcast by the operator and no row is capped.

Defined results: a null or empty text has one empty line; rows with a null id
count for no line and lose none; rows that repeat an id count as one document,
and each such row loses the lines that its own text has in excess; a text whose
lines all go becomes the empty text (n_dropped = n_lines tells it from an
originally empty one); a text of very many lines is rebuilt in time linear in
them; an empty table gives no rows; columns of any name pass through, but for
the three of `OUTPUT`, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, WHITE


def _line_key(line: str) -> str:
    """SQL: white space stripped at both ends, A-Z lowered (`lower` does that for ASCII)."""
    strip = f"btrim({line}, '{_sql(WHITE)}')"
    return (f"if(octet_length({line}) = char_length({line}), lower({strip}), "
            f"translate({strip}, '{UPPER}', '{LOWER}'))")


def _sql(chars: str) -> str:
    return "".join(f"\\u{ord(c):04x}" for c in chars)


def repeated_lines(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(_id, _text_hash, drops): positions of the lines that each document loses."""
    lines = (docs.where("_id is not null and char_length(text) >= " + str(min_chars))
             .selectExpr("_id", "_text_hash", "posexplode(split(text, '\n', -1)) as (position, line)")
             .where(f"char_length(line) >= {min_chars}")
             .selectExpr("_id", "_text_hash", "position", f"{_line_key('line')} as key")
             .where(f"char_length(key) >= {min_chars}")
             .selectExpr("_id", "_text_hash", "position", "xxhash64(key) as h1", "xxhash64(7, key) as h2"))
    common = (lines.groupBy("h1", "h2").agg(F.countDistinct("_id").alias("n"), F.max("_id").alias("keeper"))
              .where(F.col("n") >= min_docs).drop("n"))
    return (lines.join(common, ["h1", "h2"]).where("_id != keeper")
            .groupBy("_id", "_text_hash").agg(F.collect_set("position").alias("drops")))


OUTPUT = ("kept_text", "n_lines", "n_dropped")


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """All columns of `docs`, with `kept_text`, `n_lines` (before) and `n_dropped`.

    Columns of these names in `docs` are replaced.  `min_chars` counts code points of the normalised line; a document is
    compared by its id.
    """
    names = docs.columns  # the caller's names could clash with the ones used here
    inner = {c: f"_c{k}" for k, c in enumerate(names)}
    base = docs.toDF(*inner.values())
    text = f"coalesce({inner[text_col]}, '')"
    base = base.selectExpr("*", f"{inner[id_col]} as _id", f"xxhash64({inner[text_col]}) as _text_hash")
    drops = (repeated_lines(base.selectExpr("_id", f"{inner[text_col]} as text", "_text_hash"), min_chars, min_docs)
             .selectExpr("_id as _drop_id", "_text_hash as _drop_hash", "drops"))
    joined = base.join(drops, (F.col("_id") == F.col("_drop_id")) & (F.col("_text_hash") == F.col("_drop_hash")), "left")
    # the text is split once and bound to `l`; inside the inner lambda a split would run for every kept line
    kept = (f"if(drops is null, {text}, transform(array(split({text}, '\n', -1)), l -> concat_ws('\n', "
            f"transform(array_except(sequence(0, size(l) - 1), drops), i -> l[i])))[0])")
    return joined.selectExpr(
        *[f"{k} as `{c}`" for c, k in inner.items() if c not in OUTPUT], f"{kept} as kept_text",
        f"cast(char_length({text}) - char_length(replace({text}, '\n', '')) + 1 as bigint) as n_lines",
        "cast(coalesce(size(drops), 0) as bigint) as n_dropped")
