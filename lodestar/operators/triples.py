"""Triple-pattern queries (survey §2.17 G1-G5, S18) as DataFrame joins.

A graph is a (s, p, o) DataFrame. A basic graph pattern is a chain of
self-joins on the shared variable, each side first filtered on its
predicate (the filter is pushed to the scan when the triples are Parquet);
OPTIONAL is a left join. No SPARQL parser is involved: patterns are built
with the functions below.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.text import uri_local_name

# --- fixed values: the vocabulary of the emitted Turtle subset ------------
PREFIX = "ex:"
XSD_INTEGER = "xsd:integer"
# -------------------------------------------------------------------------

_LINE = r'^(\S+)\s+(\S+)\s+(.*?)\s*\.\s*$'
_TYPED = r'^"(.*)"\^\^(\S+)$'
_PLAIN = r'^"(.*)"$'


def parse_turtle_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``subject predicate object .`` lines -> (s, p, o, datatype).
    Typed literals ``"120"^^xsd:integer`` keep their lexical form in ``o``
    and their type in ``datatype``; comments/blank lines are dropped. A
    per-line regex job: every executor parses its own split of the file."""
    x = lines.where(~F.col(col).rlike(r"^\s*(#.*)?$"))
    x = x.select(F.regexp_extract(col, _LINE, 1).alias("s"),
                 F.regexp_extract(col, _LINE, 2).alias("p"),
                 F.regexp_extract(col, _LINE, 3).alias("raw"))
    typed = F.regexp_extract("raw", _TYPED, 1)
    dtype = F.regexp_extract("raw", _TYPED, 2)
    plain = F.regexp_extract("raw", _PLAIN, 1)
    o = (F.when(dtype != "", typed).when(F.col("raw").startswith('"'), plain)
          .otherwise(F.col("raw")))
    return x.select("s", "p", o.alias("o"),
                    F.when(dtype != "", dtype).alias("datatype")).where(F.col("s") != "")


def to_turtle_lines(triples: DataFrame) -> DataFrame:
    """Inverse of ``parse_turtle_lines`` (used to write a graph as text)."""
    lit = F.when(F.col("datatype").isNotNull(),
                 F.concat(F.lit('"'), F.col("o"), F.lit('"^^'), F.col("datatype")))
    lit = lit.when(F.col("o").startswith(PREFIX), F.col("o")).otherwise(
        F.concat(F.lit('"'), F.col("o"), F.lit('"')))
    return triples.select(F.concat_ws(" ", "s", "p", lit, F.lit(".")).alias("value"))


def typed_value(o: str = "o", dtype: str = "datatype"):
    """Integer literal -> INT (``try_cast``: a bad lexical form is NULL)."""
    return F.when(F.col(dtype) == XSD_INTEGER, F.expr(f"try_cast({o} AS INT)"))


def bind(triples: DataFrame, predicate: str, var: str, subject: str = "s") -> DataFrame:
    """One triple pattern ``?s <predicate> ?var`` -> (s, var)."""
    return (triples.where(F.col("p") == predicate)
                   .select(F.col("s").alias(subject), F.col("o").alias(var),
                           F.col("datatype").alias(f"{var}__dt")))


def star(triples: DataFrame, required: Sequence[tuple[str, str]],
         optional: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Subjects having every ``required`` (predicate, var) and, when
    present, the ``optional`` ones (left joins: unbound -> NULL)."""
    (p0, v0), rest = required[0], required[1:]
    out = bind(triples, p0, v0)
    for p, v in rest:
        out = out.join(bind(triples, p, v), "s")
    for p, v in optional:
        out = out.join(bind(triples, p, v), "s", "left")
    return out


def local(col: str):
    """local name of a prefixed/hash IRI."""
    return uri_local_name(F.regexp_replace(F.col(col), "^" + PREFIX, "#"))


def part_graph(part: DataFrame) -> DataFrame:
    """Stand-in graph: every part as ``ex:Part_<key>`` with ex:name,
    ex:type, ex:size (typed integer) and ex:brand. The brand ("genre") is
    absent for keys divisible by 7 and the placeholder "Unknown" for keys
    divisible by 11 (deterministic gaps for OPTIONAL / !BOUND tests)."""
    s = F.concat(F.lit(PREFIX + "Part_"), F.col("p_partkey").cast("string"))
    k = F.col("p_partkey")
    brand = F.when(k % 11 == 0, F.lit("Unknown")).otherwise(F.col("p_brand"))
    rows = F.array(
        F.struct(F.lit(PREFIX + "name").alias("p"), F.col("p_name").alias("o"),
                 F.lit(None).cast("string").alias("datatype")),
        F.struct(F.lit(PREFIX + "type").alias("p"), F.col("p_type").alias("o"),
                 F.lit(None).cast("string").alias("datatype")),
        F.struct(F.lit(PREFIX + "size").alias("p"), F.col("p_size").cast("string").alias("o"),
                 F.lit(XSD_INTEGER).alias("datatype")),
        F.struct(F.lit(PREFIX + "brand").alias("p"), brand.alias("o"),
                 F.lit(None).cast("string").alias("datatype")))
    x = part.select(s.alias("s"), k.alias("_k"), F.explode(rows).alias("t"))
    x = x.where(~((F.col("t.p") == PREFIX + "brand") & (F.col("_k") % 7 == 0)))
    return x.select("s", "t.p", "t.o", "t.datatype")
