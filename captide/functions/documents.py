"""Helpers shared by the document parsers: inflating and decoding raw bytes."""

from __future__ import annotations

import gzip
import re

GZIP_MAGIC = b"\x1f\x8b"
# What may declare a charset, and what only looks as if it did.
_DECLARATION = re.compile(rb"""\s*<\?xml\b[^>]*?\bencoding\s*=\s*["']([A-Za-z0-9_.:-]+)["']""")
_META = re.compile(rb"""<!--.*?-->|<(?:script|style)\b.*?</(?:script|style)\s*>|<meta\b[^>]*?\bcharset\s*=\s*["']?\s*([A-Za-z0-9_.:-]+)""", re.I | re.S)
_HEAD_END = re.compile(rb"</head\s*>|<body\b", re.I)


def inflate(content: bytes) -> bytes:
    """Undo gzip if the bytes carry its signature."""
    return gzip.decompress(content) if content[:2] == GZIP_MAGIC else content


def declared_charset(content: bytes) -> str | None:
    """The charset of the XML declaration or of the first ``meta`` tag in the head, however long that is."""
    found = _DECLARATION.match(content)
    if not found:
        end = _HEAD_END.search(content)
        tags = _META.finditer(content, 0, end.start() if end else len(content))
        found = next((tag for tag in tags if tag.group(1)), None)
    return found.group(1).decode("ascii") if found else None


def decode_page(content: bytes) -> str:
    """Page bytes as text: byte order mark, declared charset, UTF-8, then windows-1252."""
    for mark, codec in ((b"\xef\xbb\xbf", "utf-8-sig"), (b"\xff\xfe", "utf-16"), (b"\xfe\xff", "utf-16")):
        if content.startswith(mark):
            return content.decode(codec, "replace")
    declared = declared_charset(content)
    codecs = ["utf-8", "windows-1252"]
    # A page whose declaration could be read byte by byte is not UTF-16.
    if declared and not declared.lower().startswith("utf-16"):
        codecs.insert(0, declared)
    for codec in codecs:
        try:
            return content.decode(codec)
        except (ValueError, LookupError):
            continue
    return content.decode("utf-8", "replace")
