"""URL keys as Column expressions. Malformed URLs never raise: parts are cut out by regular expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Query keys that page a listing, in order of preference. Fixed values.
PAGE_PARAMS = ("pageIndex", "page", "start_rank", "skiptoresults", "p")
#: Query keys whose value is the real address of a redirecting link. Fixed values.
REDIRECT_PARAMS = ("url", "redirect", "u")
#: Paths that are listings, not courses. Fixed values.
LISTING_PATHS = ("/", "/courses", "/courses-atoz", "/study/courses")

_PATH = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
_HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)"
_QUERY = r"^[^?#]*\?([^#]*)"


def rstrip_slash(u: Column) -> Column:
    return F.regexp_replace(u, "/+$", "")


def path_of(u: Column) -> Column:
    return F.regexp_extract(F.trim(u), _PATH, 1)


def host_of(u: Column) -> Column:
    return F.lower(F.regexp_extract(F.trim(u), _HOST, 1))


def query_of(u: Column) -> Column:
    return F.regexp_extract(F.trim(u), _QUERY, 1)


def path_key(u: Column) -> Column:
    """Lower-cased path without closing slashes; '' for null: the key that joins one course over hosts and queries."""
    return F.coalesce(F.lower(rstrip_slash(path_of(u))), F.lit(""))


def trimmed(u: Column) -> Column:
    return F.coalesce(rstrip_slash(F.trim(u)), F.lit(""))


def normalized(u: Column, keep_query: bool = False) -> Column:
    """Without fragment, without query unless kept, without closing slashes."""
    cut = F.regexp_replace(F.trim(u), "#.*$" if keep_query else r"[?#].*$", "")
    return rstrip_slash(cut)


def _slugged(text: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(text, r"(?U)[^\w\-]+", "-"), "^-+|-+$", ""))


def slug(u: Column) -> Column:
    """What follows a `courses` segment, else the whole path, as a slug of at most 160 signs."""
    parts = F.filter(F.split(path_of(u), "/"), lambda p: p != "")
    after = F.array_position(parts, "courses").cast("int")
    tail = F.when(after > 0, _slugged(F.array_join(F.slice(parts, after + 1, F.greatest(F.size(parts), F.lit(1))), "-")))
    whole = _slugged(F.array_join(parts, "-"))
    return F.coalesce(
        F.nullif(F.substring(tail, 1, 160), F.lit("")), F.nullif(F.substring(whole, 1, 160), F.lit("")), F.lit("course")
    )


def identity(slug_: Column) -> Column:
    """A slug without its closing intake year."""
    cut = F.regexp_replace(F.trim(slug_), r"-(\d{4})-(\d{2})$", "")
    return F.when(cut == "", F.trim(slug_)).otherwise(cut)


def intake_year(slug_: Column) -> Column:
    """Start year of a slug that ends in -YYYY-YY, else 0."""
    found = F.regexp_extract(F.trim(slug_), r"-(\d{4})-(\d{2})$", 1)
    return F.coalesce(found.try_cast("int"), F.lit(0))


def intake_folder(stem: Column) -> Column:
    """'2026 - 2027' for a stem that ends in -2026-27, with the century rolled where the end is not later; else ''."""
    start = F.regexp_extract(F.trim(stem), r"-(\d{4})-(\d{2})$", 1).try_cast("int")
    end = F.regexp_extract(F.trim(stem), r"-(\d{4})-(\d{2})$", 2).try_cast("int")
    year = (F.floor(start / 100) * 100 + end).cast("int")
    year = F.when(year <= start, year + 100).otherwise(year)
    return F.coalesce(F.concat(start.cast("string"), F.lit(" - "), year.cast("string")), F.lit(""))


def rebase(u: Column, base: Column) -> Column:
    """A URL's path on another site's address; the query goes."""
    site, path = rstrip_slash(F.trim(base)), path_of(u)
    return (
        F.when(F.coalesce(F.trim(u), F.lit("")) == "", "")
        .when(F.coalesce(site, F.lit("")) == "", F.trim(u))
        .otherwise(F.concat(site, path))
    )


def redirect_target(u: Column) -> Column:
    """The absolute URL that a redirect parameter carries, else the URL itself."""
    raw = [F.regexp_extract(query_of(u), rf"(?:^|&){k}=([^&]*)", 1) for k in REDIRECT_PARAMS]
    found = [F.trim(F.try_url_decode(v)) for v in raw]
    return F.coalesce(*(F.when(f.rlike("^https?://"), f) for f in found), F.trim(u))


def page_param(u: Column) -> Column:
    """The paging key that a URL has, in its own case, else pageIndex."""
    has = [F.nullif(F.regexp_extract(query_of(u), rf"(?i)(?:^|&)({k})=", 1), F.lit("")) for k in PAGE_PARAMS]
    return F.coalesce(*has, F.lit("pageIndex"))


def page_number(u: Column) -> Column:
    """The page of a listing URL, at least 1; 1 where there is none or it is no number."""
    values = [
        F.when(
            query_of(u).rlike(rf"(?i)(?:^|&){k}="),
            F.coalesce(F.regexp_extract(query_of(u), rf"(?i)(?:^|&){k}=([^&]*)", 1).try_cast("int"), F.lit(1)),
        )
        for k in PAGE_PARAMS
    ]
    return F.greatest(F.lit(1), F.coalesce(*values, F.lit(1)))


def with_page(u: Column, page: int) -> Column:
    """The URL with its page set, the parameter being added where it has none."""
    bare = F.regexp_replace(F.trim(u), "#.*$", "")
    out = F.concat(bare, F.when(query_of(u) == "", "?").otherwise("&"), F.lit(f"pageIndex={page}"))
    for k in reversed(PAGE_PARAMS):
        out = F.when(
            query_of(u).rlike(rf"(?i)(?:^|&){k}="), F.regexp_replace(bare, rf"(?i)([?&]{k}=)[^&]*", f"$1{page}")
        ).otherwise(out)
    return F.regexp_replace(out, r"\?\?", "?")


def family_key(u: Column) -> Column:
    """One key for all pages of a listing: the URL at page 1."""
    return normalized(with_page(u, 1), keep_query=True)


def path_template(u: Column, broad: bool = False) -> Column:
    """A pattern for a path of depth 3 or more: /a/b/slug as ^/a/b/[^/]+$, or broadly as ^/a/[^/]+/[^/]+$; else null."""
    parts = F.filter(F.split(path_of(u), "/"), lambda p: p != "")
    quote = lambda c: F.regexp_replace(c, r"([^A-Za-z0-9_/])", r"\\$1")
    head = F.concat(F.lit("^/"), quote(F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), "/")))
    first = F.concat(
        F.lit("^/"), quote(F.get(parts, 0)), F.array_join(F.array_repeat(F.lit("/[^/]+"), F.greatest(F.size(parts) - 1, F.lit(0))), "")
    )
    return F.when(F.size(parts) >= 3, F.concat(first if broad else F.concat(head, F.lit("/[^/]+")), F.lit("$")))


def is_course_url(u: Column, host: str, patterns: list[str], prefixes: list[str] = (), paths: list[str] = ()) -> Column:
    """On the host, no listing or excluded path, and matching any of the path patterns."""
    key = F.when(rstrip_slash(F.lower(path_of(u))) == "", "/").otherwise(rstrip_slash(F.lower(path_of(u))))
    ok = (host_of(u) == host.lower()) & ~key.isin(*LISTING_PATHS, *paths)
    for p in prefixes:
        ok = ok & ~key.startswith(p)
    hit = F.lit(False)
    for p in patterns:
        hit = hit | path_of(u).rlike(p)
    return F.coalesce(ok & hit, F.lit(False))


def source_url(html: Column) -> Column:
    """The address of a saved page: saved-from comment, base, canonical link, og:url; '' if none."""
    head = F.substring(html, 1, 8000)
    found = [
        F.regexp_extract(head, r"(?i)saved from url=\(\d+\)(\S+)", 1),
        F.regexp_extract(head, r"""(?i)<base[^>]+href=["']([^"']+)""", 1),
        F.regexp_extract(head, r"""(?i)<link[^>]+rel=["']canonical["'][^>]+href=["']([^"']+)""", 1),
        F.regexp_extract(head, r"""(?i)<meta[^>]+property=["']og:url["'][^>]+content=["']([^"']+)""", 1),
    ]
    return F.coalesce(*(F.nullif(f, F.lit("")) for f in found), F.lit(""))
