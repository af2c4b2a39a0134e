"""Word-processor files as a Spark data source for writing: one container file a row, a paragraph a line."""

from __future__ import annotations

import html
import io
import re
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter
from pyspark.sql.types import StructType

from parlance.sources.pcm import Written, file_system

#: What an XML text may not hold.
FORBIDDEN = r"[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]"
_FORBIDDEN = re.compile(FORBIDDEN)
#: Parts of a container besides the text; fixed by the format.
PARTS = {
    "[Content_Types].xml": '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Override PartName="/word/document.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"/></Types>',
    "_rels/.rels": '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" '
    'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="word/document.xml"/></Relationships>',
}


def container(text: str) -> bytes:
    """A text as the bytes of a word-processor file; what XML forbids is left out."""
    lines = [f'<w:p><w:r><w:t xml:space="preserve">{html.escape(_FORBIDDEN.sub("", x), quote=False)}</w:t></w:r></w:p>' for x in text.split("\n")]
    body = "".join(lines)
    document = f'<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>'
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in (PARTS | {"word/document.xml": document}).items():
            z.writestr(name, data)
    return held.getvalue()


class DocumentWriter(DataSourceArrowWriter):
    """Rows of (name, text); each file is moved to its name when it is whole, so a task that runs again does no harm."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        files, base = file_system(self.path)
        files.create_dir(base, recursive=True)
        count = 0
        for batch in batches:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist(), strict=True):
                temporary = f"{base}/.{uuid.uuid4().hex}"
                with files.open_output_stream(temporary) as f:
                    f.write(container(text or ""))
                files.move(temporary, f"{base}/{name}")
                count += 1
        return Written(count)


class WordDocuments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "word_documents"

    def schema(self) -> str:
        return "name string, text string"

    def writer(self, schema: StructType, overwrite: bool) -> DocumentWriter:
        return DocumentWriter(dict(self.options))


def write_documents(texts: DataFrame, path: str, name_col: str = "name", text_col: str = "text") -> None:
    """One ``.docx`` file for each row, named by the row; ``sources.texts.documents`` reads them."""
    texts.sparkSession.dataSource.register(WordDocuments)
    name = F.concat(F.regexp_replace(F.col(name_col).cast("string"), "[^A-Za-z0-9._-]", "_"), F.lit(".docx"))
    texts.select(name.alias("name"), F.col(text_col).alias("text")).write.format("word_documents").mode("append").save(path)
