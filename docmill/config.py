"""Where the store lies and how an external database is reached: defaults, then a compose file, then DATABASE_URL or
the POSTGRES_* variables. Giving both of the last two is an error."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from urllib.parse import unquote, urlsplit

from docmill.errors import ConfigurationError

#: Defaults of the connection (fixed values).
DEFAULTS = {"host": "localhost", "port": "5432", "database": "ragdb", "user": "postgres", "password": "postgres"}
_VARIABLES = {"POSTGRES_HOST": "host", "POSTGRES_PORT": "port", "POSTGRES_DB": "database", "POSTGRES_USER": "user", "POSTGRES_PASSWORD": "password"}


def parse_url(url: str) -> dict[str, str]:
    """postgresql://user[:password]@host[:port][/database]; what is not given is left to the other sources."""
    parts = urlsplit(url)
    if parts.scheme not in ("postgresql", "postgres"):
        raise ConfigurationError(f"DATABASE_URL must start with postgresql:// or postgres://, not {parts.scheme}")
    if "@" not in parts.netloc or not parts.hostname:
        raise ConfigurationError("DATABASE_URL needs user@host")
    try:
        port = parts.port
    except ValueError:
        raise ConfigurationError("the port of DATABASE_URL is no number") from None
    given = {"host": parts.hostname, "port": port and str(port), "database": parts.path.strip("/"), "user": unquote(parts.username or ""), "password": parts.password and unquote(parts.password)}
    return {k: v for k, v in given.items() if v}


def parse_compose(text: str) -> dict[str, str]:
    """POSTGRES_* values and the published port of a compose file; what cannot be read is ignored."""
    out: dict[str, str] = {}
    for name, key in _VARIABLES.items():
        m = re.search(rf"^\s*-?\s*{name}\s*[:=]\s*[\"']?([^\"'\s#]+)", text, re.M)
        if m and not m[1].startswith("${"):
            out[key] = m[1]
    m = re.search(r"^\s*-\s*[\"']?(?:[\d.]+:)?(\d+):5432[\"']?\s*$", text, re.M)
    return out | ({"port": m[1]} if m else {})


def resolve(environment: Mapping[str, str] | None = None, compose: str | None = "postgres-compose.yml") -> dict[str, str]:
    env = os.environ if environment is None else environment
    given = {key: env[name] for name, key in _VARIABLES.items() if env.get(name)}
    url = env.get("DATABASE_URL")
    if url and given:
        raise ConfigurationError("DATABASE_URL and POSTGRES_* variables are both set; use one of them")
    out = dict(DEFAULTS)
    if compose and os.path.exists(compose):
        with open(compose) as f:
            out |= parse_compose(f.read())
    out |= parse_url(url) if url else given
    if not out["port"].isdigit():
        raise ConfigurationError(f"the port is no number: {out['port']}")
    return out


def jdbc_options(config: Mapping[str, str]) -> dict[str, str]:
    """Options of a JDBC source or sink for the same database."""
    return {"url": f"jdbc:postgresql://{config['host']}:{config['port']}/{config['database']}", "user": config["user"], "password": config["password"], "driver": "org.postgresql.Driver"}
