"""Pieces of SQL text that several queries share."""

WS = r"[\s\x{85}\x{a0}\p{Z}]"


def stripped(c: str) -> str:
    return rf"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def norm(c: str) -> str:
    return rf"regexp_replace(regexp_replace(lower({c}), '{WS}+', ' ', 'g'), '^ +| +$', '', 'g')"


def norm_or_null(c: str) -> str:
    return f"nullif({norm(c)}, '')"


def reference_key(c: str) -> str:
    bare = stripped(rf"""regexp_replace({stripped(f"lower({c})")}, '^objectid\(\s*["'']?(.*?)["'']?\s*\)$', '\1')""")
    return f"nullif(nullif(nullif({bare}, ''), 'null'), 'none')"
