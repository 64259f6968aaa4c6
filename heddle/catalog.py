"""Servers, tables and an engine: declared tables over files, registered as views of one Spark session."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .operators.stats import Statistics, analyze
from .options import extension_list, merged, validate
from .plans.pushdown import Report, report
from .sources.files import read_csv, read_parquet
from .types import DeclaredType, schema_text


@dataclass(frozen=True)
class Server:
    """A named set of options. Hosts are accepted and not used: Spark reads the files itself."""

    name: str
    options: dict[str, str] = field(default_factory=dict)

    @property
    def extensions(self) -> list[str]:
        return extension_list(self.options["extensions"]) if "extensions" in self.options else []

    @property
    def hosts(self) -> list[str]:
        return [h.strip() for h in self.options.get("host", "").split(",") if h.strip()]


@dataclass(frozen=True)
class Column:
    """A declared column; `source` is its name in the files, where that differs."""

    name: str
    type: str
    source: str | None = None


@dataclass
class Table:
    """A declared table. fragcnt and fetch_size steer reading and never change a result."""

    name: str
    columns: list[Column]
    server: Server
    options: dict[str, str]
    path: str
    df: DataFrame

    @property
    def schema_text(self) -> str:
        return schema_text([(c.source or c.name, c.type) for c in self.columns])

    @property
    def fetch_size(self) -> int:
        return int(self.options["fetch_size"])

    def rows(self):
        """The rows, fetched a partition at a time and never all held by the driver."""
        return self.df.toLocalIterator(prefetchPartitions=False)


class Engine:
    """The entry point: create servers and tables, query them, take statistics and look at plans."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.servers: dict[str, Server] = {}
        self.tables: dict[str, Table] = {}
        self.users: dict[tuple[str, str], dict[str, str]] = {}
        self.pushable: dict[str, str] = {}  # function -> extension that ships it
        spark.conf.set("spark.sql.timeType.enabled", "true")

    def create_server(self, name: str, options: dict[str, str] | None = None) -> Server:
        if name in self.servers:
            raise ValueError(f"server {name!r} exists")
        self.servers[name] = Server(name, validate("server", options or {}))
        return self.servers[name]

    def create_user(self, user: str, server: Server, options: dict[str, str] | None = None) -> None:
        """Checked and kept; files have their own permissions."""
        self.users[user, server.name] = validate("user", options or {})

    def create_table(self, name: str, columns: list, server: Server | None = None, base_dir: str = "", options: dict[str, str] | None = None, multiline: bool = True) -> Table:
        """Declares a table over the files that table_name, which may be a glob, names below base_dir, and registers a view.

        columns are (name, type) or (name, type, {"column_name": source}) or Column objects. multiline=False says that no CSV
        field holds a line end, so that large files can be split.
        """
        server = server or Server("local")
        chosen = validate("table", options or {})
        if "fmt" not in chosen:
            raise ValueError("table option fmt is not specified")
        full = merged(server.options, chosen)
        declared = [c if isinstance(c, Column) else Column(c[0], c[1], (validate("column", c[2]).get("column_name") if len(c) > 2 else None)) for c in columns]
        if len({c.name.lower() for c in declared}) < len(declared):
            raise ValueError("a column is declared twice")
        for c in declared:
            DeclaredType(c.type)
        path = "/".join(p.rstrip("/") for p in (base_dir, full.get("table_name", name)) if p)
        triples = [(c.source or c.name, c.name, c.type) for c in declared]
        df = read_parquet(self.spark, path, triples) if full["fmt"] == "parquet" else read_csv(self.spark, path, triples, full, multiline)
        fragments = int(full["fragcnt"])
        if fragments > 1 and df.rdd.getNumPartitions() < fragments:
            df = df.repartition(fragments)
        df.createOrReplaceTempView(name)
        self.tables[name] = Table(name, declared, server, full, path, df)
        return self.tables[name]

    def drop_table(self, name: str) -> None:
        self.spark.catalog.dropTempView(name)
        del self.tables[name]

    def import_directory(self, base_dir: str, names: list[str], server: Server | None = None) -> list[Table]:
        """Declares Parquet files as tables from their own footers."""
        out = []
        for name in names:
            own = self.spark.read.parquet(f"{base_dir}/{name}.parquet")
            columns = [(f.name, _declared(f.dataType)) for f in own.schema]
            out.append(self.create_table(name, columns, server, base_dir, {"fmt": "parquet", "table_name": f"{name}.parquet"}))
        return out

    def sql(self, query: str, args: dict | list | None = None) -> DataFrame:
        return self.spark.sql(query, args=args) if args is not None else self.spark.sql(query)

    def analyze(self, name: str, sample: int = 30_000, seed: int = 0) -> Statistics:
        return analyze(self.tables[name].df, sample, seed)

    def explain_pushdown(self, df: DataFrame) -> Report:
        return report(df)

    def register_function(self, name: str, function, returns, extension: str | None = None) -> None:
        """Registers a user function; with an extension it counts as pushable on servers that list the extension."""
        self.spark.udf.register(name, function, returns)
        if extension:
            self.pushable[name] = extension

    def is_pushable(self, function: str, server: Server) -> bool:
        return function in self.pushable and self.pushable[function] in server.extensions


def _declared(kind) -> str:
    from pyspark.sql import types as T

    plain = {T.BooleanType: "bool", T.ShortType: "int2", T.ByteType: "int2", T.IntegerType: "int4", T.LongType: "int8", T.FloatType: "float4", T.DoubleType: "float8", T.DateType: "date", T.TimestampNTZType: "timestamp", T.TimestampType: "timestamptz", T.StringType: "text", T.BinaryType: "bytea"}
    if isinstance(kind, T.DecimalType):
        return f"numeric({kind.precision},{kind.scale})"
    if isinstance(kind, T.ArrayType):
        return _declared(kind.elementType) + "[]"
    return plain.get(type(kind), "text")
