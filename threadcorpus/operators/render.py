"""Entity decoding and XML rendering of whole post tables (narrow projections)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadcorpus.functions.markup import decode_entities, post_html, render_text
from threadcorpus.functions.nested import nested_post_html


def decode_entities_rows(df: DataFrame, keys: Sequence[str], text_col: str, out_col: str = "decoded") -> DataFrame:
    """P11 + P12 for a table: ``(*keys, out_col)``, one row for each input row; a NULL text is empty."""
    return df.select(*keys, decode_entities(F.coalesce(F.col(text_col), F.lit(""))).alias(out_col))


def render_posts(posts: DataFrame, id_col: str = "id", body_col: str = "body", nested: bool = False) -> DataFrame:
    """X2 + P10-P14 for a table: ``(id, xml)``, every post as a ``<text>`` element; a NULL body is empty.

    ``nested`` reads the markup as nested markdown instead of the flat subset.
    """
    body = F.coalesce(F.col(body_col), F.lit(""))
    markup = nested_post_html(body) if nested else post_html(body)
    return posts.select(F.col(id_col), render_text(F.col(id_col), markup).alias("xml"))
