"""Word files: the lines of their paragraphs, read from the archive's main part."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

_NAMES = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_PARAGRAPH, _TEXT = f"{_NAMES}p", f"{_NAMES}t"
_MARKS = {f"{_NAMES}tab": "\t", f"{_NAMES}br": "\n"}


def paragraphs(content: bytes) -> Iterator[str]:
    """The text of each paragraph; each is let go of once it is read.  A file that isn't one has none."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive, archive.open("word/document.xml") as main:
            for _, element in ElementTree.iterparse(main):
                if element.tag == _PARAGRAPH:
                    yield "".join(node.text or "" if node.tag == _TEXT else _MARKS.get(node.tag, "") for node in element.iter())
                    element.clear()
    except (KeyError, ElementTree.ParseError, zipfile.BadZipFile):
        return


@F.pandas_udf(ArrayType(StringType()))
def docx_lines(contents: pd.Series) -> pd.Series:
    """Filled lines of a Word file, trimmed; null and unreadable files have none."""

    def one(content: bytes | None) -> list[str]:
        lines = (line.strip() for paragraph in paragraphs(bytes(content or b"")) for line in paragraph.splitlines())
        return [line for line in lines if line]

    return contents.map(one, na_action=None)
