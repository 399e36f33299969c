"""Values of JSON texts with their types: missing, null, "" and a wrong type are told apart.

A text is parsed once, to a variant; fields are taken from it by their kind, never by a silent cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions.digests import DIGEST

#: Fields whose numbers and true are taken as text, as keys of groups are.
AS_TEXT = ("route", "scene_id", "file", "merge_group", "speaker")


def parsed(raw: Column) -> Column:
    """The value of a whole JSON text as a variant; null if it isn't one.

    Parsers stop after the first value. So the text is put in an array before a mark made from the text
    itself, which only stands at its place if nothing but the one value came before. Objects that
    repeat a name, and NaN and Infinity, aren't JSON.
    """
    return settled(attempted(raw), raw)


def mark_of(raw: Column) -> Column:
    return F.concat(F.lit("m"), F.hex(F.xxhash64(raw)))


def attempted(raw: Column) -> Column:
    """The first half of parsed(): the array with its mark. As a column of its own it is parsed once."""
    return F.try_parse_json(F.concat(F.lit("["), raw, F.lit(',"'), mark_of(raw), F.lit('"]')))


def settled(both: Column, raw: Column) -> Column:
    """The second half of parsed()."""
    return F.when(F.try_variant_get(both, "$[1]", "string") == mark_of(raw), F.try_variant_get(both, "$[0]", "variant"))


def member(value: Column, name: str) -> Column:
    """An object's field as a variant; null if it is missing, a null variant if it is null."""
    return F.try_variant_get(value, f"$['{name}']", "variant")


def kind(value: Column) -> Column:
    """string, boolean, integer, number (with a fraction or exponent), array, object, null, or missing."""
    return kind_of(value, F.schema_of_variant(value), F.to_json(value))


def kind_of(value: Column, form: Column, text: Column) -> Column:
    """kind() of a value whose schema and JSON text are columns already, so that they are made once."""
    return (
        F.when(value.isNull(), "missing").when(form == "VOID", "null").when(form == "STRING", "string").when(form == "BOOLEAN", "boolean").when(form.startswith("ARRAY"), "array").when(form.startswith("OBJECT"), "object")
        .when((form == "BIGINT") & text.rlike("^-?[0-9]+$"), "integer").otherwise("number")
    )


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def truth(value: Column) -> Column:
    """Whether a value counts as yes: any but null, false, 0, "", [] and {}."""
    return truth_of(value, kind(value), F.to_json(value))


def truth_of(value: Column, what: Column, text: Column) -> Column:
    """truth() of a value whose kind and JSON text are columns already."""
    return F.when(what.isin("missing", "null"), False).when(what.isin("integer", "number"), F.try_variant_get(value, "$", "double") != 0).otherwise(~text.isin("false", '""', "[]", "{}"))


def strings(value: Column) -> Column:
    """An array of strings; elements of other types are null, and so is the one element for what is no array. Missing and null give null."""
    each = F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda x: F.when(kind(x) == "string", F.try_variant_get(x, "$", "string")))
    return F.when(kind(value) == "array", each).when(~kind(value).isin("missing", "null"), F.array(F.lit(None).cast("string")))


def as_text(value: Column) -> Column:
    """A string, or a number, true or other value that counts as yes, as text."""
    what = kind(value)
    return F.when(what == "string", F.try_variant_get(value, "$", "string")).when(what == "boolean", F.when(truth(value), "True").otherwise("")).when(what.isin("missing", "null"), None).when(truth(value), F.to_json(value)).otherwise("")


def field(value: Column, name: str, type_: T.DataType) -> Column:
    """An object's field in a type: by the type's rule where it has one, else null unless it has that type.

    Booleans are truth values; long takes true and false for 1 and 0; arrays of strings keep a place for
    each element; names in AS_TEXT are text. Any other type is taken as a variant gives it.
    """
    one = member(value, name)
    what = kind(one)
    if isinstance(type_, T.StringType):
        return as_text(one) if name in AS_TEXT else F.when(what == "string", F.try_variant_get(one, "$", "string"))
    if isinstance(type_, T.BooleanType):
        return truth(one)
    if isinstance(type_, (T.LongType, T.IntegerType)):
        return F.when(what.isin("integer", "boolean"), F.try_variant_get(one, "$", type_.simpleString()))
    if isinstance(type_, (T.DoubleType, T.FloatType)):
        return F.when(what.isin("integer", "number"), F.try_variant_get(one, "$", type_.simpleString()))
    if type_ == T.ArrayType(T.StringType()):
        return strings(one)
    return one if isinstance(type_, T.VariantType) else F.try_variant_get(one, "$", type_.simpleString())


def record_problem(raw: Column, value: Column, hashed: bool) -> Column:
    """The first thing that is wrong with a line that must be a record with an id and a text, and with
    hashed a digest; null if nothing is."""
    get = lambda name: F.try_variant_get(member(value, name), "$", "string")
    has = lambda name: kind(member(value, name)) == "string"
    checks = [
        ("invalid JSON", value.isNull()), ("not an object", kind(value) != "object"), ("no string id", ~(has("id") & (get("id") != ""))), ("no string text", ~has("text")),
        *([("source_hash is no digest", ~(has("source_hash") & get("source_hash").rlike(DIGEST)))] if hashed else []),
    ]
    return F.coalesce(*(F.when(F.coalesce(bad, F.lit(True)), problem) for problem, bad in checks))
