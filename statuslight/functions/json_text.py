"""Read JSON held in strings: scalars, sub-documents, arrays, and fenced model output."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NESTED = "^(OBJECT|ARRAY)"


def strip_fences(text: Column, newlines: bool = True) -> Column:
    """Remove Markdown code fences, and line feeds unless ``newlines`` is False."""
    bare = F.replace(F.replace(text, F.lit("```json"), F.lit("")), F.lit("```"), F.lit(""))
    return F.replace(bare, F.lit("\n"), F.lit("")) if newlines else bare


def parsed(text: Column) -> Column:
    """The document as a variant; NULL when the text is not valid JSON."""
    return F.try_parse_json(text)


def json_value(document: Column, path: str) -> Column:
    """The scalar at ``path`` as text; NULL for objects, arrays, JSON null and absence."""
    nested = F.schema_of_variant(F.try_variant_get(document, path, "variant")).rlike(NESTED)
    return F.when(~nested, F.try_variant_get(document, path, "string"))


def json_array(document: Column, path: str = "$") -> Column:
    """The elements of the array at ``path``; NULL when there is no array."""
    return F.try_variant_get(document, path, "array<variant>")


def answer_value(document: Column, text: Column, path: str) -> Column:
    """``json_value`` of the parsed ``text``, or of the text itself where it is no variant.

    A text whose objects repeat a key, or that is larger than a variant, has no variant.
    The first of several equal keys counts then.
    """
    raw = F.get_json_object(text, path)
    nested = raw.rlike("^\\s*[\\[{]")
    key = path[2:]
    if key.isidentifier():  # a string that begins with a bracket is none: read as an array or an object it is NULL
        shapes = [F.from_json(text, f"`{key}` {kind}")[key] for kind in ("array<string>", "map<string,string>")]
        nested = nested & (shapes[0].isNotNull() | shapes[1].isNotNull())
    return F.when(document.isNotNull(), json_value(document, path)).when(~nested, raw)


def answer_records(document: Column, text: Column, path: str, fields: list[str]) -> Column:
    """The elements of the array at ``path`` as structs of strings; NULL when there is no array.

    Where the text is no variant its array is cut into elements as text, and each is read
    by itself, so that an element that repeats a key costs neither itself nor the others.
    """
    exact = F.transform(json_array(document, path), lambda e: F.struct(*[json_value(e, f"$.{f}").alias(f) for f in fields]))
    cut = F.from_json(F.get_json_object(text, path), "array<string>")
    read = F.transform(cut, lambda e: F.struct(*[answer_value(parsed(e), e, f"$.{f}").alias(f) for f in fields]))
    return F.when(document.isNotNull(), exact).otherwise(read)


def json_query(text: Column, path: str) -> Column:
    """The JSON text at ``path``: containers as written, scalars re-quoted as JSON."""
    node = F.try_variant_get(F.try_parse_json(text), path, "variant")
    shape = F.schema_of_variant(node)
    return F.when(shape.rlike(NESTED), F.get_json_object(text, path)).when(shape != "VOID", F.to_json(node))


def json_record(**fields: Column) -> Column:
    """One JSON object per row. Fields that are NULL are kept as JSON null."""
    record = F.struct(*[value.alias(name) for name, value in fields.items()])
    return F.to_json(record, {"ignoreNullFields": "false"})
