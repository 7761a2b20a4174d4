"""What a scan is told: validated, immutable."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from typing import Any

#: Driver classes by URL prefix (fixed values).
DRIVERS = {
    "jdbc:mysql": "com.mysql.cj.jdbc.Driver",
    "jdbc:postgresql": "org.postgresql.Driver",
    "jdbc:oracle": "oracle.jdbc.OracleDriver",
    "jdbc:sqlserver": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "jdbc:derby": "org.apache.derby.jdbc.EmbeddedDriver",
}
#: Names in DDL options and what they set (fixed values).
DDL_KEYS = {
    "url": "url", "database": "database", "table-list": "table_list", "table-pattern": "table_pattern", "username": "username",
    "password": "password", "driver": "driver", "split-key-column": "split_key_column", "chunk-size": "chunk_size",
    "fetch-size": "fetch_size", "connection-timeout-ms": "connection_timeout_ms", "max-retries": "max_retries", "dialect": "dialect",
    "boundary-mode": "boundary_mode",
}
MODES = ("exact", "skip")


@dataclass(frozen=True)
class ScanOptions:
    """``table_list`` or ``table_pattern``, never both. ``fetch_size`` is a hint to the driver and limits nothing."""

    url: str
    database: str
    table_list: tuple[str, ...] = ()
    table_pattern: str | None = None
    username: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    split_key_column: str | None = None
    chunk_size: int = 8096
    fetch_size: int = 1024
    connection_timeout_ms: int = 30000
    max_retries: int = 3
    dialect: str = "mysql"
    boundary_mode: str = "exact"

    def __post_init__(self) -> None:
        if not self.url or not self.database:
            raise ValueError("url and database are required")
        names = [self.table_list] if isinstance(self.table_list, str) else self.table_list
        object.__setattr__(self, "table_list", tuple(x.strip() for name in names for x in name.split(",") if x.strip()))
        if bool(self.table_list) == bool(self.table_pattern):
            raise ValueError("give either a table list or a table pattern")
        if self.chunk_size < 1:
            raise ValueError("chunk_size must be at least 1")
        if self.max_retries < 0 or self.connection_timeout_ms < 0:
            raise ValueError("max_retries and connection_timeout_ms must not be negative")
        if self.boundary_mode not in MODES:
            raise ValueError(f"boundary_mode must be one of {MODES}")
        from chunkscan.sources.dialect import dialect_named

        dialect_named(self.dialect)

    @property
    def driver_class(self) -> str:
        if self.driver:
            return self.driver
        for prefix, name in DRIVERS.items():
            if self.url.startswith(prefix):
                return name
        raise ValueError(f"no driver is known for {self.url}; name one")

    @classmethod
    def from_ddl(cls, options: Mapping[str, str]) -> ScanOptions:
        """From string options with hyphens in their names."""
        unknown = sorted(set(options) - set(DDL_KEYS))
        if unknown:
            raise ValueError(f"unknown options: {', '.join(unknown)}")
        missing = [k for k in ("url", "database") if not options.get(k)]
        if missing:
            raise ValueError(f"missing options: {', '.join(missing)}")
        kinds = {f.name: f.type for f in fields(cls)}
        values: dict[str, Any] = {}
        for key, text in options.items():
            name = DDL_KEYS[key]
            values[name] = int(text) if kinds[name] == "int" else (text,) if name == "table_list" else text
        return cls(**values)

    def connection(self) -> dict[str, str]:
        """Reader options of Spark's JDBC source."""
        found = {"url": self.url, "driver": self.driver_class, "fetchsize": str(max(0, self.fetch_size)), "user": self.username, "password": self.password, "preferTimestampNTZ": "true"}
        if not self.url.startswith("jdbc:derby"):
            found["connectTimeout"] = str(self.connection_timeout_ms)
        return {k: v for k, v in found.items() if v is not None}


class ScanBuilder:
    """Collects settings one by one; a whole options object, if given, wins over all of them."""

    def __init__(self) -> None:
        self._set: dict[str, Any] = {}
        self._options: ScanOptions | None = None
        self._schema: Any = None

    def __getattr__(self, name: str):
        if name.startswith("_") or name not in {f.name for f in fields(ScanOptions)}:
            raise AttributeError(name)

        def setter(*values: Any) -> ScanBuilder:
            self._set[name] = tuple(values) if name == "table_list" else values[0]
            return self

        return setter

    def options(self, options: ScanOptions) -> ScanBuilder:
        self._options = options
        return self

    def schema(self, schema: Any) -> ScanBuilder:
        self._schema = schema
        return self

    def build(self) -> tuple[ScanOptions, Any]:
        """The options and the declared schema, which is required."""
        if self._schema is None:
            raise ValueError("a schema is required")
        return self._options or ScanOptions(**self._set), self._schema


def with_options(options: ScanOptions, **changes: Any) -> ScanOptions:
    return replace(options, **changes)
