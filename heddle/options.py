"""Legal options of servers, tables and columns, and their checks."""

from __future__ import annotations

import difflib

# Option names by kind of object.
SERVER = {
    "host", "dbname", "port", "fragcnt", "fetch_size", "batch_size", "extensions", "use_remote_estimate", "fdw_startup_cost", "fdw_tuple_cost",
    "updatable", "truncatable", "async_capable", "parallel_commit", "keep_connections",
}
TABLE = {
    "schema_name", "table_name", "fmt", "csv_delimiter", "csv_quote", "csv_escape", "csv_header", "csv_nullstr", "use_remote_estimate", "fetch_size", "batch_size",
    "updatable", "truncatable", "async_capable",
}
COLUMN = {"column_name"}
USER = {"user", "password", "password_required", "sslcert", "sslkey"}
LEGAL = {"server": SERVER, "table": TABLE, "column": COLUMN, "user": USER}

_BOOLEAN = {"use_remote_estimate", "updatable", "truncatable", "async_capable", "parallel_commit", "keep_connections", "password_required", "csv_header"}
_POSITIVE = {"fetch_size", "batch_size", "fragcnt"}
_COST = {"fdw_startup_cost", "fdw_tuple_cost"}
_SINGLE = {"csv_delimiter", "csv_quote", "csv_escape"}
_TRUE, _FALSE = {"true", "t", "yes", "y", "on", "1"}, {"false", "f", "no", "n", "off", "0"}

DEFAULTS = {"fragcnt": "1", "fetch_size": "100", "csv_delimiter": ",", "csv_quote": '"', "csv_escape": '"', "csv_header": "false", "csv_nullstr": ""}


def boolean(value: str) -> bool:
    low = str(value).strip().lower()
    if low not in _TRUE | _FALSE:
        raise ValueError(f"not a boolean: {value!r}")
    return low in _TRUE


def extension_list(value: str) -> list[str]:
    names = [x.strip() for x in value.split(",")]
    if any(not n or any(c.isspace() for c in n) for n in names):
        raise ValueError(f"extensions must be names with commas between them: {value!r}")
    return names


def validate(kind: str, options: dict[str, str]) -> dict[str, str]:
    """The options as strings; raises ValueError for an unknown name, with the legal ones, or for a bad value."""
    legal = LEGAL[kind]
    checked = {}
    for name, value in options.items():
        value = str(value)
        if name not in legal:
            near = difflib.get_close_matches(name, legal, 1)
            hint = f"perhaps you meant {near[0]!r}; " if near else ""
            raise ValueError(f"invalid option {name!r} of a {kind}: {hint}valid options are {', '.join(sorted(legal))}")
        if name in _BOOLEAN:
            try:
                boolean(value)
            except ValueError:
                raise ValueError(f"{name} requires a boolean value, not {value!r}") from None
        elif name in _POSITIVE:
            if not value.strip().isdigit() or int(value) <= 0:
                raise ValueError(f"{name!r} must be an integer greater than zero, not {value!r}")
        elif name in _COST:
            try:
                fine = float(value) >= 0
            except ValueError:
                fine = False
            if not fine:
                raise ValueError(f"{name!r} must be a number of zero or more, not {value!r}")
        elif name in _SINGLE:
            if len(value) != 1:
                raise ValueError(f"{name!r} must be one character, not {value!r}")
        elif name == "extensions":
            extension_list(value)
        elif name == "fmt" and value not in ("csv", "parquet"):
            raise ValueError(f"fmt must be csv or parquet, not {value!r}")
        checked[name] = value
    return checked


def merged(server: dict[str, str], table: dict[str, str]) -> dict[str, str]:
    """Defaults, then the server's options, then the table's."""
    return DEFAULTS | {k: v for k, v in server.items()} | table
