"""Reading feed products kept as VARIANT.

VARIANT is what tells a missing key (SQL NULL) from an explicit JSON null.
The columns come in steps, each using those of the step before.
"""

from __future__ import annotations

import json
import re
from functools import reduce
from json.decoder import scanstring

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from wareloom.functions.text import ascii_digits, strip
from wareloom.functions.urls import product_link
from wareloom.schemas import AVAILABLE, NOT_AVAILABLE, OUT_OF_STOCK

PLAIN_NUMBER = r"^[+-]?(\d(_?\d)*\.?(\d(_?\d)*)?|\.\d(_?\d)*)([eE][+-]?\d(_?\d)*)?$"
# First value that no longer fits a decimal(10,2) after rounding.
PRICE_LIMIT = 99_999_999.995

PRODUCT = ("struct<title: variant, vendor: variant, body_html: variant, product_type: variant, "
           "handle: variant, variants: variant>")
VARIANT = "struct<price: variant, available: variant>"
#: The same fields as plain text, and the column that is set where a body does not fit.
TEXTS = "struct<title: string, vendor: string, body_html: string, product_type: string, handle: string, variants: array<struct<price: string>>>"
MISFIT = "misfit"


MISSING, NULL, OBJECT, ARRAY, BOOLEAN, STRING = "", "VOI", "OBJ", "ARR", "BOO", "STR"


def field(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "variant")


def as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def kind(value: Column) -> Column:
    """First three letters of a value's type: '' for a missing key, VOI for null."""
    return F.substring(F.coalesce(F.schema_of_variant(value), F.lit("")), 1, 3)


def is_nested(value_kind: Column) -> Column:
    return value_kind.isin(OBJECT, ARRAY)


def truthy(value: Column, value_kind: Column, text: Column) -> Column:
    """False for a missing key, null, false, zero and anything empty.

    ``text`` is the value as text, so that callers can work it out once.
    """
    return (
        F.when(value_kind.isin(MISSING, NULL), False)
        .when(value_kind == STRING, text != "")
        .when(value_kind == BOOLEAN, F.try_variant_get(value, "$", "boolean"))
        .when(value_kind == ARRAY, field(value, "$[0]").isNotNull())
        .when(value_kind == OBJECT, F.schema_of_variant(value) != "OBJECT<>")
        .otherwise(text.try_cast("double") != 0)
    )


def number_text(text: Column) -> Column:
    return strip(ascii_digits(text))


def parse_number(text: Column) -> Column:
    """Double, or NULL where the text is not one plain number.

    The pattern keeps out what a bare cast would let through, such as a
    trailing type suffix.
    """
    return F.when(text.rlike(PLAIN_NUMBER), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))


TEXT_FIELDS = {
    # column: (key in the product, value for a missing key)
    "title": ("title", NOT_AVAILABLE),
    "vendor": ("vendor", NOT_AVAILABLE),
    "description": ("body_html", ""),
    "category": ("product_type", NOT_AVAILABLE),
}


_BLANKS = re.compile(r"[ \t\n\r]*")


def split_products(body: str) -> list[str] | None:
    """The texts of the products on a page, each as it stands there; None where the page has no list of them.

    Goes through the page's members and through the list one value at a time,
    so that no more than one product is held as a value.
    """
    decoder = json.JSONDecoder()

    def after(at: int, *signs: str) -> tuple[str, int]:
        at = _BLANKS.match(body, at).end()
        if body[at:at + 1] not in signs:
            raise ValueError(f"{signs} expected at {at}")
        return body[at], at + 1

    def value(at: int) -> tuple[int, int]:
        start = _BLANKS.match(body, at).end()
        return start, decoder.raw_decode(body, start)[1]

    products = None
    try:
        _, at = after(0, "{")
        if body.startswith("}", _BLANKS.match(body, at).end()):
            return None
        sign = ","
        while sign == ",":
            _, at = after(at, '"')
            key, at = scanstring(body, at)
            _, at = after(at, ":")
            start = _BLANKS.match(body, at).end()
            if key == "products" and body[start:start + 1] == "[":
                products, at = [], start + 1
                inner = _BLANKS.match(body, at).end()
                item = body[inner:inner + 1]
                if item == "]":
                    at = inner + 1
                while item != "]":
                    begin, at = value(at)
                    products.append(body[begin:at])
                    item, at = after(at, ",", "]")
            else:
                # A key that comes again counts by its last value.
                products = None if key == "products" else products
                _, at = value(at)
            sign, at = after(at, ",", "}")
        if _BLANKS.match(body, at).end() != len(body):
            return None
    except (ValueError, RecursionError):
        return None
    return products


@F.arrow_udf(T.ArrayType(T.StringType()))
def _split_bodies(bodies: pa.Array) -> pa.Array:
    return pa.array([None if body is None else split_products(body) for body in bodies.to_pylist()], pa.list_(pa.string()))


def large_products(body: Column, is_large: Column) -> Column:
    """Texts of the products of bodies that may be more than a VARIANT holds; only these bodies leave Spark."""
    return _split_bodies(F.when(is_large, body))


def product_list(document: Column, parts: Column, body: Column) -> Column:
    """Products of one page, one struct of raw values and plain texts each; NULL without a list.

    ``parts`` are the products as texts, where the page is more than one VARIANT holds.
    """
    whole = F.try_variant_get(document, "$.products", f"array<{PRODUCT}>")
    raw = F.coalesce(whole, F.transform(parts, lambda p: F.try_variant_get(F.try_parse_json(p), "$", PRODUCT)))
    # NULL without a list; asking for that first would read the list twice.
    return F.arrays_zip(raw.alias("raw"), plain_texts(body).alias("texts"))


def plain_texts(body: Column) -> Column:
    """The text fields of each product, read as text; empty where not all of the body fits, so that none may be at a wrong place.

    Much quicker than a text out of a VARIANT, but only good for values that are texts there.
    """
    read = F.from_json(body, f"products array<{TEXTS}>, {MISFIT} string", {"columnNameOfCorruptRecord": MISFIT})
    return F.coalesce(F.when(read[MISFIT].isNull(), read["products"]), F.array().cast(f"array<{TEXTS}>"))


def raw_columns(product: Column) -> dict[str, Column]:
    product, texts = product["raw"], product["texts"]
    raw = {f"raw_{name}": product[key] for name, (key, _) in TEXT_FIELDS.items()}
    plain = {f"plain_{name}": texts[key] for name, (key, _) in TEXT_FIELDS.items()}
    return {
        **raw,
        **plain,
        "raw_handle": product["handle"],
        "plain_handle": texts["handle"],
        "plain_price": F.get(texts["variants"], F.lit(0))["price"],
        "raw_variants": product["variants"],
        "missing": product.isNull(),
        "first": F.try_variant_get(product["variants"], "$[0]", VARIANT),
    }


def text_of(value: Column, value_kind: Column, plain: Column) -> Column:
    """``as_text``, by the plain text where the value is one."""
    return F.when((value_kind == STRING) & plain.isNotNull(), plain).otherwise(as_text(value))


def kind_columns() -> dict[str, Column]:
    first = F.col("first")
    kinds = {f"{name}_kind": kind(F.col(f"raw_{name}")) for name in [*TEXT_FIELDS, "handle"]}
    return {
        **kinds,
        "price_kind": kind(first["price"]),
        "available_kind": kind(first["available"]),
        "handle_text": text_of(F.col("raw_handle"), kind(F.col("raw_handle")), F.col("plain_handle")),
        "price_text": text_of(first["price"], kind(first["price"]), F.col("plain_price")),
    }


def value_columns(base_url: Column) -> dict[str, Column]:
    first, handle, price = F.col("first"), F.col("handle_text"), F.col("price_text")
    texts = {
        # Only a missing key takes the default, JSON null stays NULL.
        name: F.when(F.col(f"{name}_kind") == MISSING, default).otherwise(
            text_of(F.col(f"raw_{name}"), F.col(f"{name}_kind"), F.col(f"plain_{name}")))
        for name, (_, default) in TEXT_FIELDS.items()
    }
    has_handle = truthy(F.col("raw_handle"), F.col("handle_kind"), handle)
    available = truthy(first["available"], F.col("available_kind"), as_text(first["available"]))
    return {
        "product_url": product_link(base_url, F.when(has_handle, handle)),
        **texts,
        "availability": F.when(available, AVAILABLE).otherwise(OUT_OF_STOCK),
        "has_price": F.coalesce(truthy(first["price"], F.col("price_kind"), price), F.lit(False)),
        "price_text": number_text(price),
    }


def price_column() -> dict[str, Column]:
    """0.0 without a price, NULL where it is not a number."""
    kind_of_price = F.col("price_kind")
    return {"price": (
        F.when(~F.col("has_price"), 0.0)
        .when(is_nested(kind_of_price), F.lit(None).cast("double"))
        .when(kind_of_price == BOOLEAN, 1.0)
        .otherwise(parse_number(F.col("price_text")))
    )}


def reject_reason() -> Column:
    # The type of all variants is costly to find and only asked for without a first one.
    variants = F.col("raw_variants")
    no_first = F.when(F.col("first").isNull(), truthy(variants, kind(variants), as_text(variants)))
    nested = reduce(Column.__or__, [is_nested(F.col(f"{name}_kind")) for name in TEXT_FIELDS])
    usable_price = F.coalesce(F.abs(F.col("price")) < PRICE_LIMIT, F.lit(False))
    return (
        F.when(F.col("missing"), "product is not an object")
        .when(no_first, "first variant is not an object")
        .when(nested, "text field is nested")
        .when(~usable_price, "bad price")
        .when(F.col("title").isNull(), "title is null")
    )
