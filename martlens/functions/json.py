"""JSON objects as text: checking them and editing one member, while every
other byte stays as it came (duplicate keys, long numbers, blanks)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"
# strings, structural characters, and what stands between them
_TOKEN = r'"(?:[^"\\]|\\.)*+"|[{}\[\],:]|[^"{}\[\],:]++'


def object_fields(text: Column, names: tuple[str, ...]) -> Column:
    """Struct of the named members as text (the last one of a repeated key), and
    ``_corrupt``, which is not null where the text is no JSON."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, CORRUPT)])
    return F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT, "allowSingleQuotes": "false"})


def is_one_object(text: Column, fields: Column) -> Column:
    """Is the text exactly one JSON object?  ``fields``: see ``object_fields``.
    A parser stops behind the first value.  Where the last character is the only
    closing brace, nothing follows.  Else what follows would have to end an array
    here and an object there, so only the end of the text passes both."""
    flat = F.rtrim(text).endswith("}") & (F.char_length(text) - F.char_length(F.replace(text, F.lit("}"), F.lit(""))) == 1)
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    member = F.json_object_keys(F.concat(F.lit('{"v":'), text, F.lit("}"))) == F.array(F.lit("v"))
    whole = F.when(flat, F.lit(True)).otherwise(alone & member)
    return F.coalesce(F.json_object_keys(text).isNotNull() & fields.getField(CORRUPT).isNull() & whole, F.lit(False))


def without_member(text: Column, name: str) -> Column:
    """An object's text without its top-level members ``name``; members of
    nested objects stay.  One pass over the tokens."""
    def step(acc: Column, token: Column) -> Column:
        depth, expect, skip = acc.getField("depth"), acc.getField("expect"), acc.getField("skip")
        kept, pending, out = acc.getField("kept"), acc.getField("pending"), acc.getField("out")
        opens, closes = token.isin("{", "["), token.isin("}", "]")
        comma = (depth == 1) & (token == ",")
        last = (depth == 1) & closes
        key = (depth == 1) & expect & token.startswith('"')
        blank = (depth == 1) & expect & ~key & ~last & ~comma
        # a key may be written with escapes
        named = key & (F.get_json_object(F.concat(F.lit("["), token, F.lit("]")), "$[0]") == name)
        lead = F.when(kept, pending).otherwise(F.regexp_replace(pending, "^,", ""))
        emitted = (F.when(comma | blank | named, F.lit(""))
                   .when(key, F.concat(lead, token))
                   .when(last, F.concat(F.when(expect, lead).otherwise(F.lit("")), token))
                   .when(skip, F.lit("")).otherwise(token))
        return F.struct(
            (depth + opens.cast("int") - closes.cast("int")).alias("depth"),
            F.when((depth == 0) & opens | comma, F.lit(True)).when(key, F.lit(False)).otherwise(expect).alias("expect"),
            F.when(comma | last, F.lit(False)).when(key, named).otherwise(skip).alias("skip"),
            (kept | key & ~named).alias("kept"),
            F.when(comma, F.lit(",")).when(blank, F.concat(pending, token)).when(key, F.lit("")).otherwise(pending).alias("pending"),
            F.concat(out, emitted).alias("out"))

    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("expect"), F.lit(False).alias("skip"),
                     F.lit(False).alias("kept"), F.lit("").alias("pending"), F.lit("").alias("out"))
    return F.aggregate(F.regexp_extract_all(text, F.lit(_TOKEN), 0), start, step, lambda acc: acc.getField("out"))


def with_number(text: Column, name: str, value: Column) -> Column:
    """An object's text with its top-level member ``name`` set to a number: the
    old member goes, the new one stands last, nothing else changes."""
    keys = F.json_object_keys(text)
    rest = F.when(F.array_contains(keys, name), without_member(text, name)).otherwise(text)
    body = F.regexp_replace(rest, r"\}\s*$", "")
    comma = F.when(F.size(F.array_remove(keys, name)) > 0, F.lit(",")).otherwise(F.lit(""))
    return F.concat(body, comma, F.lit(f'"{name}":'), value.cast("string"), F.lit("}"))
