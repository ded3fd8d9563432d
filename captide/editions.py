"""Settings that differ between the corpus releases."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Edition:
    """How one release names its archive members and writes its time links."""

    name: str
    member_prefix: str
    member_suffix: str
    link_pattern: str
    listing_html_only: bool
    repr_pattern: str | None


# Member names, link patterns and repr patterns of the releases.
# (?d) keeps "\r" inside "." so that only "\n" ends a line.
EDITIONS = {
    "2014": Edition(
        name="2014",
        member_prefix="html/",
        member_suffix=".html.gz",
        link_pattern=r"(?d)^.*#start/(\d+)/end/(\d+)",
        listing_html_only=False,
        repr_pattern=None,
    ),
    "2017": Edition(
        name="2017",
        member_prefix="html/",
        member_suffix=".html.gz",
        link_pattern=r"^/start/(\d+)/end/(\d+)",
        listing_html_only=False,
        repr_pattern=None,
    ),
    "2022": Edition(
        name="2022",
        member_prefix="html/",
        member_suffix=".html",
        link_pattern=r"^/start/(\d+)/end/(\d+)",
        listing_html_only=True,
        repr_pattern=r"""(?d)b['"](.*)['"]""",
    ),
    "2023": Edition(
        name="2023",
        member_prefix="html-2023/",
        member_suffix=".html",
        link_pattern=r"^/start/(\d+)/end/(\d+)",
        listing_html_only=False,
        repr_pattern=r"(?d)b'(.*)'",
    ),
}


def edition(name: str) -> Edition:
    """The settings of one release, by name."""
    if name not in EDITIONS:
        raise ValueError(f"unknown edition {name!r}; known: {', '.join(EDITIONS)}")
    return EDITIONS[name]
