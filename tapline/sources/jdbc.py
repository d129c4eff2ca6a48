"""JDBC: addresses, credentials and parallel reads."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession, types as T

from tapline.errors import ExtractionError
from tapline.options import ConnectionOptions, Split
from tapline.sources import ranges

# Fixed value: seconds to wait for a login.
LOGIN_TIMEOUT = 10


@dataclass(frozen=True)
class Address:
    url: str
    driver: str
    options: dict = field(default_factory=dict, repr=False)


def _pairs(connection_string: str) -> dict[str, str]:
    pairs = re.findall(r"\s*([^=;]+?)\s*=\s*(\{(?:[^}]|\}\})*\}|[^;]*)\s*(?:;|$)", connection_string)
    return {
        key: value[1:-1].replace("}}", "}") if value.startswith("{") else value.strip() for key, value in pairs
    }


def parse_keys(connection_string: str) -> dict[str, str]:
    """``Key=value;`` pairs with lower-case keys; braces around a value are removed, and may hold semicolons."""
    return {key.lower(): value for key, value in _pairs(connection_string).items()}


def _first(keys: dict[str, str], *names: str, default: str = "") -> str:
    return next((keys[n] for n in names if keys.get(n)), default)


def _host_port(server: str, port: str, default_port: str) -> str:
    host, _, inline_port = server.replace(",", ":").partition(":")
    return f"{host}:{port or inline_port or default_port}"


def _mysql(keys: dict[str, str], server: str, database: str) -> Address:
    options = {"connectTimeout": str(LOGIN_TIMEOUT * 1000)}
    charset = _first(keys, "charset")
    if charset:
        options["characterEncoding"] = "UTF-8" if charset.lower() in ("utf8", "utf8mb4") else charset
    host = _host_port(server, _first(keys, "port"), "3306")
    return Address(f"jdbc:mysql://{host}/{database}", "com.mysql.cj.jdbc.Driver", options)


def _sql_server(keys: dict[str, str], server: str, database: str) -> Address:
    options = {"loginTimeout": str(LOGIN_TIMEOUT), "databaseName": database}
    if "encrypt" in keys:
        options["encrypt"] = "false" if keys["encrypt"].lower() in ("no", "false", "optional") else "true"
    if "trustservercertificate" in keys:
        options["trustServerCertificate"] = "true" if keys["trustservercertificate"].lower() in ("yes", "true") else "false"
    server = re.sub(r"^tcp:", "", server, flags=re.IGNORECASE)
    # A named instance is looked up by name, so it gets a port only if one is given.
    named = "\\" in server and not _first(keys, "port") and not re.search(r"[,:]", server)
    host = server if named else _host_port(server, _first(keys, "port"), "1433")
    return Address(f"jdbc:sqlserver://{host}", "com.microsoft.sqlserver.jdbc.SQLServerDriver", options)


def _db2(keys: dict[str, str], server: str, database: str) -> Address:
    host = _host_port(server, _first(keys, "port"), "50000")
    return Address(f"jdbc:db2://{host}/{database}", "com.ibm.db2.jcc.DB2Driver", {"loginTimeout": str(LOGIN_TIMEOUT)})


def _postgres_keys(keys: dict[str, str], server: str, database: str) -> Address:
    host = _host_port(server, _first(keys, "port"), "5432")
    options = {"loginTimeout": str(LOGIN_TIMEOUT), "sslmode": _first(keys, "sslmode", default="verify-full")}
    return Address(f"jdbc:postgresql://{host}/{database}", "org.postgresql.Driver", options)


def _oracle_keys(keys: dict[str, str], server: str, database: str) -> Address:
    place = _first(keys, "dbq") or f"{_host_port(server, _first(keys, 'port'), '1521')}/{database}"
    prefix = "" if place.startswith("(") else "//"
    return Address(f"jdbc:oracle:thin:@{prefix}{place}", "oracle.jdbc.OracleDriver")


# Words that tell a driver name or the file of its library, tried in this order.
_BY_DRIVER_NAME = (
    (("mysql", "mariadb", "maodbc", "myodbc"), _mysql),
    (("mssql", "sql server", "sqlserver", "msodbcsql", "freetds", "tds"), _sql_server),
    (("db2",), _db2),
    (("postgres", "psql"), _postgres_keys),
    (("oracle", "sqora"), _oracle_keys),
)

# Keys whose meaning is taken over above; all others go to the driver as they are.
_TAKEN = {
    "driver", "server", "hostname", "host", "servername", "port", "database", "dbname", "db", "dbq", "uid", "user",
    "username", "pwd", "password", "charset", "encrypt", "trustservercertificate", "sslmode",
}

# JDBC driver classes by url prefix, for connection strings that are urls already.
_DRIVER_BY_URL = {
    "jdbc:derby:": "org.apache.derby.jdbc.EmbeddedDriver",
    "jdbc:postgresql:": "org.postgresql.Driver",
    "jdbc:mysql:": "com.mysql.cj.jdbc.Driver",
    "jdbc:sqlserver:": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "jdbc:db2:": "com.ibm.db2.jcc.DB2Driver",
    "jdbc:oracle:": "oracle.jdbc.OracleDriver",
}


def _generic_address(connection_string: str, url: str | None = None) -> Address:
    """A JDBC url is taken as it is, with the driver that is registered for it unless its class is known or given; so is
    the ``url`` of jdbc_options, which stands for any connection string, also one that names a DSN."""
    if url or connection_string.startswith("jdbc:"):
        url = url or connection_string
        return Address(url, next((d for prefix, d in _DRIVER_BY_URL.items() if url.startswith(prefix)), ""))
    keys = parse_keys(connection_string)
    name = _first(keys, "driver").lower()
    build = next((b for words, b in _BY_DRIVER_NAME if any(w in name for w in words)), None)
    if build is None:
        raise ExtractionError("connection", f"no JDBC driver is known for Driver={{{_first(keys, 'driver')}}}")
    server = _first(keys, "server", "hostname", "host", "servername", default="localhost")
    address = build(keys, server, _first(keys, "database", "dbname", "db"))
    login = {"user": _first(keys, "uid", "user", "username"), "password": _first(keys, "pwd", "password")}
    rest = {k: v for k, v in _pairs(connection_string).items() if k.lower() not in _TAKEN}
    return Address(address.url, address.driver, {**rest, **address.options, **{k: v for k, v in login.items() if v}})


def address(conn: ConnectionOptions) -> Address:
    """Driver, url and options; credentials only ever stand in the options."""
    target = conn.connection_string
    if conn.datasource_type == "ODBC":
        # The connection string carries the login; user_name and password are not looked at.
        return _generic_address(target, conn.jdbc.get("url"))
    if conn.datasource_type == "POSTGRES":
        options = {
            "user": conn.user_name or "", "password": conn.password or "",
            "sslmode": "verify-full", "loginTimeout": str(LOGIN_TIMEOUT),
        }
        if target.startswith("jdbc:"):
            return Address(target, _generic_address(target).driver, {k: options[k] for k in ("user", "password")})
        return Address(f"jdbc:postgresql://{target}", "org.postgresql.Driver", options)
    if not conn.user_name or not conn.password:
        raise ExtractionError("connection", "an Oracle source needs user_name and password")
    login = {"user": conn.user_name, "password": conn.password}
    if target.startswith("jdbc:"):
        return Address(target, _generic_address(target).driver, login)
    prefix = "" if target.lstrip().startswith("(") else "//"
    return Address(f"jdbc:oracle:thin:@{prefix}{target}", "oracle.jdbc.OracleDriver", login)


def _reader_options(conn: ConnectionOptions) -> dict[str, str]:
    where = address(conn)
    driver = {"driver": where.driver} if where.driver else {}
    return {
        "fetchsize": str(conn.batch_size), "preferTimestampNTZ": "true", **where.options, "url": where.url, **driver,
        **{k: str(v) for k, v in conn.jdbc.items()},
    }


def _kept_as_text(schema: T.StructType, datasource_type: str) -> list[str]:
    """Columns whose exact value the driver's own mapping would lose, and that are read as text instead."""
    def lossy(f: T.StructField) -> bool:
        name = f.metadata.get("jdbcClientType", "").lower()
        if datasource_type == "POSTGRES":
            return name == "numeric" and f.dataType == T.DecimalType(38, 18)
        if datasource_type == "ORACLE":
            return (name == "number" and f.metadata.get("scale") == -127) or "with time zone" in name
        return False

    return [f.name for f in schema.fields if lossy(f)]


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read(spark: SparkSession, conn: ConnectionOptions, query: str) -> DataFrame:
    """One connection per partition; without a split there is one of each, and the source's row order is kept."""
    options = _reader_options(conn)

    def reader():
        return spark.read.format("jdbc").options(**options)

    whole = reader().option("query", query).load()
    as_text = _kept_as_text(whole.schema, conn.datasource_type)
    if as_text:
        options["customSchema"] = ", ".join(f"{_quote(n)} STRING" for n in as_text)
        whole = reader().option("query", query).load()
    split = conn.split
    if split is None or (split.column is None and not split.predicates):
        return whole
    table = f"({query}) q"
    predicates = _predicates(spark, options, query, split, whole)
    if predicates:
        properties = {k: v for k, v in options.items() if k != "url"}
        return spark.read.jdbc(options["url"], table, predicates=list(predicates), properties=properties)
    if split.lower is None or split.upper is None:
        return whole
    parts = split.partitions or spark.sparkContext.defaultParallelism
    return (
        reader().option("dbtable", table).option("partitionColumn", split.column)
        .option("lowerBound", str(split.lower)).option("upperBound", str(split.upper)).option("numPartitions", str(parts))
        .load()
    )


def _asked(spark: SparkSession, options: dict, query: str) -> Callable[[list[str]], tuple]:
    """The one row of aggregates over the query, by the database."""
    plain = {k: v for k, v in options.items() if k != "customSchema"}

    def ask(wanted: list[str]) -> tuple:
        named = ", ".join(f"{text} c{i}" for i, text in enumerate(wanted))
        asked = spark.read.format("jdbc").options(**plain).option("query", f"SELECT {named} FROM ({query}) b")
        return tuple(asked.load().first())

    return ask


def _predicates(spark: SparkSession, options: dict, query: str, split: Split, whole: DataFrame) -> tuple[str, ...]:
    """The predicates of a split; none where bounds are given, which Spark cuts into equal strides."""
    if split.predicates:
        return split.predicates
    dialect, name = ranges.dialect_of(spark, options["url"]), split.column
    field = next((f for f in whole.schema.fields if f.name == name.strip('"`')), None)
    if name in whole.columns:
        # The name as the database reports it, in the quotes of its dialect.
        name = dialect.quoteIdentifier(name)
    if split.days:
        return range_predicates(name, ranges.date_literals(spark, options["url"], split.days))
    if split.lower is not None and split.upper is not None:
        return ()
    if field is None or not isinstance(field.dataType, ranges.COUNTED):
        raise ExtractionError("data", f"cannot split a read along {split.column}: not a number, date or timestamp of the result")

    def wanted(rows: int) -> int:
        return split.partitions or max(spark.sparkContext.defaultParallelism, -(-rows // ranges.ROWS_PER_RANGE))

    literal = ranges.literal_writer(spark, dialect, field.dataType)
    return range_predicates(name, ranges.even_cuts(_asked(spark, options, query), name, literal, wanted))


def read_in_ranges(spark: SparkSession, conn: ConnectionOptions, query: str, folder: str) -> DataFrame:
    """The query result, range by range, staged in a folder that a later run goes on with."""
    options = _reader_options(conn)
    whole = read(spark, conn.with_split(None), query)
    as_text = _kept_as_text(whole.schema, conn.datasource_type)
    if conn.split is None:
        raise ExtractionError("data", "a read that can go on needs a split or an order key")

    def of_range(predicate: str) -> DataFrame:
        return read(spark, conn.with_split(Split(predicates=(predicate,))), query)

    def all_ranges() -> tuple[str, ...]:
        return _predicates(spark, options, query, replace(conn.split, lower=None, upper=None), whole)

    return ranges.staged_ranges(spark, of_range, all_ranges, f"{options['url']}\n{query}\n{as_text}", folder)


def modulo_predicates(column: str, parts: int) -> tuple[str, ...]:
    """Predicates on an integer key that together cover every row once, whatever the key's distribution."""
    rest = f"MOD(ABS({column}), {parts})"
    return tuple(f"{rest} = {i}" + (f" OR {column} IS NULL" if i == 0 else "") for i in range(parts))


def range_predicates(column: str, cuts: list[str]) -> tuple[str, ...]:
    """Half-open ranges between sorted literals of the database's dialect, open at both ends, NULL in the first."""
    if not cuts:
        return ("1 = 1",)
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return (f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}")
