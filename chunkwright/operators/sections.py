"""Sectionisers as table functions [X5, X7]: called from SQL over any table of lines, one document at a time in the order of its lines.

    SELECT * FROM markdown_parts(TABLE(lines), 'doc_id', 'n', 'line')
    SELECT * FROM heading_parts(TABLE(lines), 'doc_id', 'n', 'line', 'Outlook|Summary')

The first result column is the key, under its own name and type; a section is held only until the next one opens.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession
from pyspark.sql.types import LongType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

_BLANKS = " \t\n\r\f\v"
H2 = re.compile(r"##[ \t\n\r\f\v]+(.+?)[ \t\n\r\f\v]*")


def _analyze(lines: AnalyzeArgument, key: AnalyzeArgument, order: AnalyzeArgument, line: AnalyzeArgument) -> AnalyzeResult:
    names = [a.value for a in (key, order, line)]
    if not lines.isTable or any(not isinstance(n, str) for n in names):
        raise ValueError("expected TABLE(...), and the names of the key, the order and the line as strings")
    known = {f.name: f for f in lines.dataType.fields}
    if missing := [n for n in names if n not in known]:
        raise ValueError(f"the table has no column {', '.join(missing)}")
    schema = StructType().add(known[names[0]]).add("section", LongType()).add("heading", StringType()).add("text", StringType())
    return AnalyzeResult(schema, partitionBy=[PartitioningColumn(names[0])], orderBy=[OrderingColumn(names[1])])


class _Sections:
    """Lines of one key; ``opens`` gives the heading of a line that opens a section."""

    def __init__(self) -> None:
        self.key, self.section, self.heading, self.held = None, 0, "Overview", []

    def _feed(self, row, key: str, line: str, heading: str | None):
        self.key = row[key]
        if heading is not None:
            yield from self._close()
            self.section, self.heading, self.held = self.section + 1, heading, []
        self.held.append(row[line] or "")

    def _close(self):
        text = "\n".join(self.held).strip(_BLANKS)
        if text:
            yield self.key, self.section, self.heading, text

    def terminate(self):
        yield from self._close()


class MarkdownParts(_Sections):
    """[X5] Parts that open with a heading of the second level; what stands before the first is ``Overview``, deeper headings stay inside."""

    @staticmethod
    def analyze(lines, key, order, line) -> AnalyzeResult:
        return _analyze(lines, key, order, line)

    def eval(self, lines, key, order, line):
        found = H2.fullmatch(lines[line] or "")
        yield from self._feed(lines, key, line, found[1].strip(_BLANKS) if found else None)


class HeadingParts(_Sections):
    """[X7] Parts that open with a line that is one of the headings, any case, alone but for blanks."""

    @staticmethod
    def analyze(lines, key, order, line, pattern) -> AnalyzeResult:
        re.compile(pattern.value)
        return _analyze(lines, key, order, line)

    def eval(self, lines, key, order, line, pattern):
        found = re.fullmatch(rf"[ \t\f\v\r]*({pattern})[ \t\f\v\r]*", lines[line] or "", re.I)
        yield from self._feed(lines, key, line, found[1] if found else None)


def register(spark: SparkSession) -> None:
    from pyspark.sql.functions import udtf

    spark.udtf.register("markdown_parts", udtf(MarkdownParts))
    spark.udtf.register("heading_parts", udtf(HeadingParts))
