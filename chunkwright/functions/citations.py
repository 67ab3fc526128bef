"""[C7] Citations: address, text and anchor of a chunk."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import is_pdf_url, link, time_label


def citation(corpus: Column, title: Column, url: Column, slide: Column, seconds: Column) -> Column:
    """struct(url, text, html) by corpus: images none, slides and videos by place, PDF pages by a page link, else the source."""
    name = F.nullif(F.trim(title), F.lit(""))
    pdf = is_pdf_url(url) & slide.isNotNull()
    page = slide.cast("bigint").cast("string")
    cited = F.when(corpus == "memes", F.lit(None)).when(corpus.isin("lecturer/lectures", "youtube"), url).when(pdf, F.concat(url, F.lit("#page="), page)).otherwise(url)
    text = (
        F.when(corpus == "memes", F.lit(None))
        .when(corpus == "lecturer/lectures", F.concat(name, F.when(slide.isNotNull(), F.concat(F.lit(", slide "), page)).otherwise(F.lit(""))))
        .when(corpus == "youtube", F.concat(name, F.when(seconds.isNotNull(), F.concat(F.lit(", "), time_label(seconds))).otherwise(F.lit(""))))
        .when(pdf, F.concat(name, F.lit(", p. "), page))
        .otherwise(name)
    )
    return F.struct(cited.cast("string").alias("url"), text.cast("string").alias("text"), link(cited.cast("string"), text.cast("string")).alias("html"))
