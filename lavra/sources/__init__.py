"""Reading and writing: delimited and plain text files, Parquet, JDBC, file manifests."""

from lavra.sources.files import (
    SourceSpec,
    charset_probe,
    detect_charset,
    first_lines,
    line_counts,
    line_occurrences,
    read_checked,
    read_delimited,
    read_group,
    read_lines,
    read_parquet,
    structure_probe,
    write_delimited,
)
from lavra.sources.jdbc import JdbcTarget, count_jdbc, jdbc_shape, read_jdbc, write_jdbc
from lavra.sources.manifest import compare_manifests, file_manifest
from lavra.sources.sink import (
    WriteResult,
    counted_write,
    publish_staged,
    staged_path,
    write_parquet,
    write_verified,
)
from lavra.sources.survey import CHARSETS, Reading, best_charset, survey
from lavra.sources.versions import (
    Publication,
    PublishError,
    VersionedTable,
    publish_all,
)

__all__ = [name for name in dir() if not name.startswith("_")]
