"""Visually identical texts with different characters.

Defined results: null texts are left out; an empty text is in its ordinary
form; a text of any length is read whole; repeated rows give a row each in
:func:`consistent` and one per distinct text in :func:`groups`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanloom.llm import forms


def consistent(df: DataFrame, keys: Sequence[str], text: str, wider: str, only_odd: bool, with_form: bool, confusables: str | None = None) -> DataFrame:
    """Columns ``keys``, odd, and with ``with_form`` text, form and skeleton.

    ``wider`` is a boolean column: whether the Persian and Urdu letters and
    joiners are ordinary in the row. ``only_odd`` keeps the rows that were not
    in their consistent form. ``confusables`` is a file with more look-alikes
    (:func:`forms.load_confusables`) that all executors can read.
    """
    types = dict(df.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "odd boolean", *(["text string", "form string", "skeleton string"] if with_form else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = len(keys)
            texts, wide = b.column(n).to_pylist(), b.column(n + 1).to_pylist()
            odd = [forms.is_odd(t, forms.PERSIAN_URDU if w else "", confusables) for t, w in zip(texts, wide)]
            at = pa.array([i for i, x in enumerate(odd) if x or not only_odd], pa.int64())
            cols = [b.column(i).take(at) for i in range(n)] + [pa.array(odd).take(at) if len(odd) else pa.array([], pa.bool_())]
            names = [*keys, "odd"]
            if with_form:
                picked = [(texts[i], forms.PERSIAN_URDU if wide[i] else "") for i in at.to_pylist()]
                cols += [pa.array([t for t, _ in picked], pa.string()), pa.array([forms.ordinary(t, k, confusables) for t, k in picked], pa.string()), pa.array([forms.skeleton(t, "", confusables) for t, _ in picked], pa.string())]
                names += ["text", "form", "skeleton"]
            yield pa.record_batch(cols, names=names)

    src = df.select(*keys, F.col(text).alias("_t"), F.coalesce(F.col(wider), F.lit(False)).alias("_w")).where("_t IS NOT NULL")
    return src.mapInArrow(run, schema)


def groups(df: DataFrame, text: str, wider: str) -> DataFrame:
    """Texts that look the same: one row per skeleton with several spellings.

    Columns skeleton, n_rows, n_forms, least and most (the first and last
    spelling). Spellings are counted before they are grouped, so a spelling
    that holds a third of all rows is one row of the second step.
    """
    per_text = df.where(F.col(text).isNotNull()).groupBy(F.col(text).alias("t"), F.coalesce(F.col(wider), F.lit(False)).alias("w")).agg(F.count("*").alias("n"))
    s = consistent(per_text, ["n"], "t", "w", False, True)
    return (
        s.groupBy("skeleton", "text").agg(F.sum("n").alias("n"))
        .groupBy("skeleton").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_forms"), F.min("text").alias("least"), F.max("text").alias("most"))
        .where("n_forms > 1")
    )
