"""Scans: XML snapshots and JSON lines."""

from __future__ import annotations

import codecs
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from pyspark.sql.types import ArrayType, StructField, StructType, VariantType

from certweave import schema as S
from certweave.functions import text as X
from certweave.sources import order as O

# ``_record_seq`` is the place of a record in its files (see ``order``): it grows from file to
# file by path and inside a file from byte to byte, is unique, and is the same for any splits and cores.
_SEQ = "_record_seq"
_FILE = "_source_file"


# The element that makes a record, and the parts of XML that matter before elements are told apart.
ELEMENT = "Certificate"
OPENING = f"<{ELEMENT}(?=[\\s/>])"
EMPTY_ELEMENT = f"(?s)^<{ELEMENT}(\\s[^<>]*)?/>"
COMMENT = "(?s)<!--.*?(-->|$)"
UNKNOWN_REFERENCE = "&(?!(?:amp|lt|gt|quot|apos);)[A-Za-z_][A-Za-z0-9_.\\-]*;"
STRAY_AMPERSAND = "&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);)"
DECLARED_ENCODING = "^\\W{0,3}<\\?xml[^>]*?encoding\\s*=\\s*[\"']([A-Za-z0-9._\\-]+)"


# How a file in UTF-16 begins, with a byte order mark or with the first sign of its markup.
WIDE_HEADS = {"fffe": "utf-16-le", "3c00": "utf-16-le", "feff": "utf-16-be", "003c": "utf-16-be"}


def _wide_encoding() -> Column:
    """The UTF-16 form of a file by its first two bytes; null for another file."""
    head = F.lower(F.hex(F.substring(F.col("value").cast("binary"), 1, 2)))
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in WIDE_HEADS.items() for x in pair]), head)


def wide_files(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """The files in UTF-16 by their encoding: one pass over all files in short pieces, of which the first of each file is looked at.

    The driver gets the paths of these files.
    """
    pieces = spark.read.option("lineSep", ">").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    pieces = pieces.withColumn("_at", F.monotonically_increasing_id()).where("start = 0")
    first = pieces.groupBy("file").agg(F.min_by(_wide_encoding(), F.col("_at")).alias("encoding"))
    found = {}
    for r in first.where("encoding is not null").orderBy("file").collect():
        found.setdefault(r.encoding, []).append(r.file)
    return found


def declared_encoding() -> Column:
    """By file split, the encoding that the XML declaration names; null without one. An aggregate over the rows of a split, ``_at`` their order."""
    name = F.lower(F.regexp_extract("value", DECLARED_ENCODING, 1))
    declares = (F.col("start") == 0) & (name != "")
    return F.min_by(F.when(declares, name), F.when(declares, F.col("_at")))


def _refused() -> Column:
    """By file split, an error where a file in UTF-16 is read without having been looked for. Lines of such a file begin with other bytes than its head."""
    wide = F.when(F.col("start") == 0, F.min_by(_wide_encoding(), F.col("_at")))
    return F.when(wide.isNotNull(), F.raise_error(F.concat(F.lit("a file in UTF-16, to be read with wide=True: "), F.col("file"))))


def _decoded_by_file(parts: DataFrame, names: list[str]) -> DataFrame:
    """parts with the value of each row decoded by ``encoding``, one of the names; UTF-8 where it is null."""
    value = F.col("value")
    for n in names:
        if not _is_utf8(n):
            value = F.when(F.col("encoding") == n, _decoded(F.col("value"), n)).otherwise(value)
    return parts.withColumn("value", value)


def _is_utf8(encoding: str) -> bool:
    return codecs.lookup(encoding).name in ("utf-8", "utf-8-sig", "ascii")


def _decoded(value: Column, encoding: str) -> Column:
    """Text of a line that the text scan took as UTF-8 whatever its bytes are. Encodings of one byte per character, UTF-8 and UTF-16 of a known byte order."""
    if _is_utf8(encoding):
        return value
    name = codecs.lookup(encoding).name
    if name in WIDE_HEADS.values():  # half a sign at the end of a cut file goes
        whole = F.expr("octet_length(value) - octet_length(value) % 2")
        return F.decode(F.substr(value.cast("binary"), F.lit(1), whole), name.upper().replace("-LE", "LE").replace("-BE", "BE"))
    upper = [bytes([b]).decode(name, "replace") for b in range(128, 256)]
    if any(len(c) != 1 for c in upper) or bytes(range(128)).decode(name, "replace") != bytes(range(128)).decode("ascii"):
        raise ValueError(f"encoding {encoding} is not one byte per character")
    return F.translate(F.decode(value.cast("binary"), "ISO-8859-1"), "".join(map(chr, range(128, 256))), "".join(upper))


def _without_cdata(value: Column) -> Column:
    """CDATA sections as plain escaped text, so that markup inside them is none."""
    def part(x: Column, i: Column) -> Column:
        inside = F.substring_index(x, "]]>", 1)
        behind = F.substr(x, F.length(inside) + 4)
        for char, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            inside = F.replace(inside, F.lit(char), F.lit(escaped))
        return F.when(i == 0, x).otherwise(F.concat(inside, behind))

    return F.array_join(F.transform(F.split(value, r"<!\[CDATA\["), part), "")


def _pieces(plain: Column) -> Column:
    """A text split at every opening tag, without what stands before the first. Where the tag's name occurs once, a search of its place does."""
    name = F.lit(f"<{ELEMENT}")
    start = F.instr(plain, name)
    once = (F.locate(f"<{ELEMENT}", F.substr(plain, start + len(ELEMENT) + 1)) == 0) & F.substr(plain, start, F.lit(len(ELEMENT) + 2)).rlike(f"^{OPENING}")
    several = F.regexp_extract_all(plain, F.lit(f"(?s){OPENING}.*?(?={OPENING}|$)"), F.lit(0))
    return F.when((start > 0) & once, F.array(F.substr(plain, start))).otherwise(several)


def read_elements(spark: SparkSession, path: str | list[str], encoding: str | None = None, *, wide: bool = False) -> DataFrame:
    """The text of every record element (value, _source_file, _record_seq).

    The closing tag is the line separator of a text scan, so one large snapshot
    is read by many tasks. What stands before a closing tag is split at every
    opening tag: an element without a closing tag ends where the next one opens
    and costs itself only, an empty element is one of its own. Comments go
    (one that holds several closing tags hides the first of its records only).
    Without an ``encoding`` the one that each file declares counts for its own rows.

    ``wide`` looks for files in UTF-16 first, by one pass more; these are split at the bytes of the closing tag in
    their encoding. Without it such a file is an error, as its tags would not be seen. The signs of a file in UTF-16 must be valid.
    """
    close = f"</{ELEMENT}>"
    file = F.col("_metadata.file_path")
    known = [encoding] if encoding and codecs.lookup(encoding).name in WIDE_HEADS.values() else []
    found_wide = {} if encoding else wide_files(spark, path) if wide else {}

    def scan(name: str | None) -> tuple[DataFrame, int]:
        separator = close.encode(name).decode("ascii") if name else close  # the tag's bytes in UTF-16 are ASCII signs and zeros
        parts = spark.read.option("lineSep", separator).text(path)
        if name in found_wide:
            parts = parts.where(file.isin(found_wide[name]))
        elif found_wide:
            parts = parts.where(~file.isin([f for fs in found_wide.values() for f in fs]))
        parts = parts.select("value", F.col("_metadata.file_name").alias(_FILE), file.alias("file"), F.col("_metadata.file_block_start").alias("start"))
        return parts.withColumns({"_separator": F.lit(len(separator)), "_wide": F.lit(name).cast("string")}), len(separator)

    scans = [scan(codecs.lookup(n).name) for n in known] or [scan(None), *[scan(n) for n in found_wide]]
    every = reduce(DataFrame.unionAll, [s[0] for s in scans])
    about = F.lit(encoding).cast("string") if encoding else F.coalesce(F.max("_wide"), declared_encoding())
    if not encoding and not wide:
        about = F.coalesce(_refused(), about)
    found = O.splits(every, F.col("_separator"), encoding=about)
    if not encoding:  # the split at a file's beginning speaks for all of them
        found = found.withColumn("encoding", F.max(F.when(F.col("start") == 0, F.col("encoding"))).over(W.partitionBy("file")))
    names = sorted(r[0] for r in found.select("encoding").distinct().where("encoding is not null").collect())  # a row per encoding
    placed = [O.positioned(s.drop("_separator", "_wide"), n, found) for s, n in scans]
    parts = _decoded_by_file(reduce(DataFrame.unionAll, placed), names)
    plain = F.when(F.col("value").contains("<!"), F.regexp_replace(_without_cdata(F.col("value")), COMMENT, "")).otherwise(F.col("value"))
    pieces = _pieces(F.col("plain"))

    def whole(x: Column, i: Column) -> Column:
        empty = F.regexp_extract(x, EMPTY_ELEMENT, 0)
        return F.when(empty != "", empty).when(i == F.size("pieces") - 1, F.concat(x, F.lit(close))).otherwise(x)

    rows = parts.where(F.col("value").rlike(OPENING)).select(plain.alias("plain"), _FILE, O.POSITION)
    # pieces of a line are fewer than its bytes, so their numbers never reach the next line's position
    rows = rows.withColumn("pieces", pieces).select(F.posexplode(F.transform("pieces", whole)).alias("_piece", "value"), _FILE, O.POSITION)
    return rows.select("value", _FILE, (F.col(O.POSITION) + F.col("_piece")).alias(_SEQ))


def _unwrap(row: Column) -> list[Column]:
    """Wrapper elements become plain arrays."""
    def sup(s: Column) -> Column:
        return s.withField("EducationalPrograms", s["EducationalPrograms"]["EducationalProgram"])

    return [
        *[row[f].alias(f) for f in S.CERTIFICATE_FIELDS],
        row[S.ORGANIZATION].alias(S.ORGANIZATION),
        F.transform(row["Supplements"]["Supplement"], sup).alias("Supplements"),
        row["Decisions"]["Decision"].alias("Decisions"),
    ]


def parse_elements(elements: DataFrame, *, strict: bool = False) -> DataFrame:
    """One raw all-text record per element.

    References without a meaning in XML are dropped before parsing, as are stray
    ampersands. An element that still cannot be read is kept as a row with its
    whole text in ``_corrupt_record``, so that it can be counted; ``strict`` fails instead.
    """
    options = {"rowTag": ELEMENT, "mode": "FAILFAST" if strict else "PERMISSIVE",
               "columnNameOfCorruptRecord": "_corrupt_record", "ignoreNamespace": "true"}
    tidy = F.when(F.col("value").contains("&"), F.regexp_replace(F.regexp_replace("value", UNKNOWN_REFERENCE, ""), STRAY_AMPERSAND, "")).otherwise(F.col("value"))
    rows = elements.withColumn("r", F.from_xml(tidy, S.xml_row_type().simpleString(), options))
    r = F.col("r")
    return rows.select(*_unwrap(r), r["_corrupt_record"].alias("_corrupt_record"), _FILE, _SEQ)


def read_xml(spark: SparkSession, path: str | list[str], *, strict: bool = False, encoding: str | None = None, wide: bool = False) -> DataFrame:
    return parse_elements(read_elements(spark, path, encoding, wide=wide), strict=strict)


def element_tags(elements: DataFrame) -> DataFrame:
    """Names of all tags inside the elements as ``tag`` rows."""
    names = F.array_distinct(F.regexp_extract_all("value", F.lit("<([A-Za-z_][A-Za-z0-9_.\\-]*)"), F.lit(1)))
    return elements.select(F.explode(names).alias("tag"))


def element_paths(elements: DataFrame, known: list[str]) -> DataFrame:
    """(tag, path, place, _record_seq) of the tags inside the elements whose names are not ``known``; names without their prefixes.

    path: the tags around it and itself, from the record's element down, joined by slashes; place: the
    number of the tag in its element. One pass over the tags of an element with the open ones as state; a closing tag ends the innermost open
    one of its name, and what was left open in between.
    """
    shape = "struct<open:array<string>,place:int,found:array<struct<tag:string,path:string,place:int>>>"
    start = F.struct(F.array().cast("array<string>").alias("open"), F.lit(0).alias("place"), F.array().cast("array<struct<tag:string,path:string,place:int>>").alias("found"))

    def step(state: Column, token: Column) -> Column:
        name = F.regexp_extract(token, r"^</?(?:[^\s/>:]*:)?([^\s/>:]+)", 1)
        closes, empty = token.startswith("</"), token.endswith("/>")
        here = F.concat(state["open"], F.array(name))
        last = F.size(state["open"]) - F.array_position(F.reverse(state["open"]), name).cast("int")  # how many stay open
        left = F.when(closes, F.when(last < F.size(state["open"]), F.slice(state["open"], 1, last)).otherwise(state["open"])).when(empty, state["open"]).otherwise(here)
        new = F.struct(name.alias("tag"), F.array_join(here, "/").alias("path"), state["place"].alias("place"))
        found = F.when(~closes & ~name.isin(known), F.concat(state["found"], F.array(new))).otherwise(state["found"])
        return F.struct(left.alias("open"), (state["place"] + 1).alias("place"), found.alias("found")).cast(shape)

    tags = F.regexp_extract_all("value", F.lit(r"</?[A-Za-z_][^<>]*>"), F.lit(0))
    return elements.select(_SEQ, F.explode(F.aggregate(tags, start.cast(shape), step, lambda a: a["found"])).alias("x")).select("x.*", _SEQ)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines (value, _source_file, _record_seq)."""
    parts = spark.read.text(path).select(
        "value", F.col("_metadata.file_name").alias(_FILE), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    return O.positioned(parts, 1, O.splits(parts, 1)).select("value", _FILE, F.col(O.POSITION).alias(_SEQ))


def line_kind(c: Column) -> Column:
    """``blank`` / ``bad_json`` / ``not_object`` / ``object``."""
    shape = F.schema_of_variant(F.try_parse_json(c))
    return (
        F.when(X.is_blank(c), "blank").when(shape.isNull(), "bad_json")
        .when(shape.startswith("OBJECT"), "object").otherwise("not_object")
    )


def limit_lines(lines: DataFrame, n: int) -> DataFrame:
    """The first ``n`` non-blank lines, whether they parse or not."""
    return O.first_rows(lines.where(~X.is_blank(F.col("value"))), n, _SEQ)


def limit_parsed(lines: DataFrame, n: int) -> DataFrame:
    """The first ``n`` lines that are JSON; unreadable ones use up nothing."""
    return O.first_rows(lines.where(line_kind(F.col("value")).isin("object", "not_object")), n, _SEQ)


def _record_schema() -> StructType:
    return StructType([StructField(f.name, f.dataType) for f in S.record_type().fields])


def _objects(array: Column, item: StructType, finish=lambda x: x) -> Column:
    """Typed items of an array of variants; an item that is no object becomes null and keeps its place."""
    return F.transform(array, lambda v: F.when(F.schema_of_variant(v).startswith("OBJECT"), finish(F.from_json(F.to_json(v), item))))


def parse_records(lines: DataFrame) -> DataFrame:
    """Typed records of the lines that hold an object; every other line is left out.

    Arrays are taken apart item by item, so one odd item costs itself only.
    """
    objects = lines.where(line_kind(F.col("value")) == "object")
    keep = [c for c in lines.columns if c != "value"]
    shape = _record_schema()
    sup_shape = S.supplement_type()
    programs = sup_shape["EducationalPrograms"].dataType
    loose = StructType([StructField(f.name, ArrayType(VariantType()) if f.name == "EducationalPrograms" else f.dataType) for f in sup_shape.fields])

    def supplement(x: Column) -> Column:
        found = _objects(x["EducationalPrograms"], programs.elementType)
        return F.struct(*[(found if f.name == "EducationalPrograms" else x[f.name]).alias(f.name) for f in sup_shape.fields])

    plain = StructType([f for f in shape.fields if f.name not in ("Supplements", "Decisions")])
    parsed = objects.select(F.from_json("value", plain).alias("r"), F.try_parse_json("value").alias("v"), *keep)
    items = lambda name: F.expr(f"try_variant_get(v, '$.{name}', 'array<variant>')")
    none = lambda name: F.array().cast(S.record_type()[name].dataType)
    return parsed.select(
        *[F.col(f"r.{f.name}") if f.name in plain.names else F.coalesce(
            _objects(items(f.name), loose, supplement) if f.name == "Supplements" else _objects(items(f.name), S.decision_type()), none(f.name)).alias(f.name)
          for f in shape.fields], *keep)


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_records(read_lines(spark, path))
