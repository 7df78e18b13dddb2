"""Shared helpers of the operator tests."""

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Names of result columns of several operators, as extra input columns.
CLASH = ["hits", "score", "found", "fp", "row", "places", "spans", "tokens", "topic", "n_words", "p", "out", "component_id", "predicted", "kept", "rate"]


def lower(text):
    return (text or "").translate(LOWER)


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def clashing(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("x").alias(c) for c in CLASH])
