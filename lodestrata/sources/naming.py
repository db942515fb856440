"""Output table names, their checks, and run-time settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from lodestrata.functions.chunking import ChunkOptions

# Name postfixes, the placeholder that must be replaced, setting names and defaults.
POSTFIXES = {"docs": "docs", "chunked": "docs_chunked", "index": "docs_chunked_index"}
PLACEHOLDER = "REPLACE_ME"
SETTINGS = {
    "bundle.ai_parser_version": "1.1",
    "bundle.catalog_name": "test_catalog",
    "bundle.schema_name": "test_schema",
    "bundle.volume_name": "test_volume",
    "bundle.source_table_name": "rag_demo_raw_files",
    "bundle.parsed_table_name": "rag_demo_parsed",
    "bundle.chunked_table_name": "rag_demo_chunked",
    "bundle.max_chunk_size": "1850",
    "bundle.min_chunk_size": "250",
}


def quote_name(name: str) -> str:
    """Back-quote every part of a dotted name when it holds a hyphen."""
    return ".".join(f"`{part}`" for part in name.split(".")) if "-" in name else name


def table_name(catalog: str, schema: str, base: str, postfix: str, version: str | None = None, quote: bool = True) -> str:
    name = f"{catalog}.{schema}.{base}_{postfix}" + (f"__{version}" if version else "")
    return quote_name(name) if quote else name


def name_part(name: str, part: int) -> str:
    """Catalog (0) or schema (1) of a table name, without quotes."""
    return name.replace("`", "").split(".")[part]


def require_set(value: str) -> str:
    if value == PLACEHOLDER:
        raise ValueError(f"the value {PLACEHOLDER!r} must be replaced by a real setting")
    return value


@dataclass(frozen=True)
class OutputTables:
    """The three output names: parsed documents, chunks, index."""

    docs: str
    chunked: str
    index: str

    @classmethod
    def of(
        cls,
        docs: str | None = None,
        chunked: str | None = None,
        index: str | None = None,
        catalog: str | None = None,
        schema: str | None = None,
        base: str | None = None,
        version: str | None = None,
        postfixes: dict[str, str] | None = None,
    ) -> OutputTables:
        """Either all three names, or catalog, schema and base name to build them from; not both."""
        if docs and chunked and index:
            if catalog or schema or base:
                raise ValueError("give either table names or the parts to build them from, not both")
            return cls(docs, chunked, index)
        if not (catalog and schema and base):
            raise ValueError("give all three table names, or catalog, schema and base name")
        for part in (catalog, schema, base):
            require_set(part)
        names = {**POSTFIXES, **(postfixes or {})}
        # the index name is never quoted
        return cls(
            *(table_name(catalog, schema, base, names[kind], version, quote=kind != "index") for kind in POSTFIXES)
        )

    def check(self, spark: SparkSession) -> tuple[bool, str]:
        """Whether the catalog and schema of every name exist, with a message."""
        for kind, name in (("docs", self.docs), ("chunked", self.chunked), ("index", self.index)):
            catalog, schema = name_part(name, 0), name_part(name, 1)
            if not spark.catalog.listCatalogs(catalog):
                return False, f"catalog '{catalog}' of the {kind} table does not exist"
            if not spark.catalog.databaseExists(f"`{catalog}`.`{schema}`"):
                return False, f"schema '{schema}' of the {kind} table does not exist in catalog '{catalog}'"
        return True, "all catalogs and schemas exist"


def setting(spark: SparkSession, name: str) -> str:
    """A run-time setting, or its default."""
    return spark.conf.get(name, SETTINGS[name])


def chunk_options(spark: SparkSession) -> ChunkOptions:
    return ChunkOptions(int(setting(spark, "bundle.max_chunk_size")), int(setting(spark, "bundle.min_chunk_size")))
