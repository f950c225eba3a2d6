"""Resolution of references against a base, by the steps of the URL standard.

Host names are lower-cased; names in other scripts and the drive letters of file URLs are left as they are.
"""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from .kinds import SIMPLE

#: Special schemes with their default ports, and what the standard escapes.
PORTS = {"http": "80", "https": "443", "ws": "80", "wss": "443", "ftp": "21", "file": ""}
IN_QUERY = "\"#<> '"
IN_FRAGMENT = '"<>` '
IN_PATH = '"#<>?^`{} '
FORBIDDEN_IN_HOST = re.compile(r"[\x00-\x20\x7f#/:<>?@\[\\\]^|%]")
SCHEME = re.compile(r"([a-zA-Z][a-zA-Z0-9+.-]*):")
ENDS = "".join(map(chr, range(33)))
ONE_DOT, TWO_DOTS = {".", "%2e"}, {"..", ".%2e", "%2e.", "%2e%2e"}


def _escaped(text: str, also: str) -> str:
    return "".join(c if 0x20 <= ord(c) < 0x7F and c not in also else "".join(f"%{b:02X}" for b in c.encode()) for c in text)


def _without_dots(path: str) -> str:
    """A path that starts with a slash, without . and .. segments."""
    out: list[str] = []
    segments = path.split("/")[1:]
    for i, s in enumerate(segments):
        dots = s.lower()
        if dots in TWO_DOTS:
            del out[-1:]
        elif dots not in ONE_DOT:
            out.append(s)
            continue
        if i == len(segments) - 1:
            out.append("")
    return "/" + "/".join(out)


def _is_ipv6(text: str) -> bool:
    try:
        return bool(ipaddress.IPv6Address(text))
    except ValueError:
        return False


def _host(authority: str, scheme: str) -> str | None:
    """user@host:port as the standard writes it; None if it is no host."""
    user, at, place = authority.rpartition("@")
    m = re.fullmatch(r"(\[[0-9a-fA-F:.]+\]|[^:]*)(?::(\d*))?", place)
    if not m or not m[1] and scheme != "file":
        return None
    if not (m[1].startswith("[") and _is_ipv6(m[1][1:-1]) or not FORBIDDEN_IN_HOST.search(m[1])):
        return None
    port = m[2] and str(int(m[2]))
    if port and int(port) > 65535:
        return None
    user = _escaped(user, "\"#<>?`{}/;=@[\\]^| ") if at else ""
    return (f"{user}@" if user.strip(":") else "") + m[1].lower() + (f":{port}" if port and port != PORTS[scheme] else "")


def resolved(reference: str | None, base: str | None = None) -> str | None:
    """The URL that a reference means at a base; None where the standard fails, and for null references."""
    if reference is None:
        return None
    ref = re.sub(r"[\t\n\r]", "", reference.strip(ENDS))
    whole = resolved(base) if base else None
    at = re.match(r"([^:]+):(?://([^/?#]*)(/[^?#]*)(\?[^#]*)?)?", whole) if whole else None
    m = SCHEME.match(ref)
    scheme = m[1].lower() if m else None
    if scheme and scheme not in PORTS:
        return f"{scheme}:{_escaped(ref[m.end() :], '')}"
    own = bool(scheme and at and at[2] is not None and at[1] == scheme and not re.match(r"[/\\]", ref[m.end() :]))
    if scheme and not own:
        rest = "//" + ref[m.end() :].lstrip("/\\")
    elif not at or at[2] is None:  # nothing to be relative to
        return f"{whole.partition('#')[0]}{ref}" if whole and ref.startswith("#") else None
    else:
        scheme, rest = at[1], ref[m.end() :] if own else ref
    rest, hash_, fragment = rest.partition("#")
    rest, mark, query = rest.partition("?")
    rest = rest.replace("\\", "/")
    if rest.startswith("//"):
        authority, slash, path = rest[2:].partition("/")
        host = _host(authority, scheme)
        if host is None:
            return None
        path = "/" + path
    else:
        host = at[2]
        path = rest if rest.startswith("/") else at[3] if not rest else at[3].rpartition("/")[0] + "/" + rest
    asked = f"?{_escaped(query, IN_QUERY)}" if mark else (at[4] or "") if not rest and at else ""
    return f"{scheme}://{host}{_without_dots(_escaped(path, IN_PATH))}{asked}" + (f"#{_escaped(fragment, IN_FRAGMENT)}" if hash_ else "")


@F.pandas_udf(SIMPLE["string"])
def absolute(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Column form of ``resolved`` (reference, base)."""
    for reference, base in batches:
        yield pd.Series([resolved(r, b) for r, b in zip(reference, base, strict=True)], dtype="object")
