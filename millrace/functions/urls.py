"""URL normalizers as Column functions. They differ on purpose: each is the identity key of another table.

They read http(s) URLs of the usual form; whatever is not of that form gives null. Hosts are compared in lower case as written (no IDNA);
IPv6 addresses are judged by their first group as written.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: scheme, user, host, port, path, query, fragment
PARTS = r"^(?i:(https?))://(?:([^/?#@]*)@)?(\[[0-9a-fA-F:.]+\]|[^/?#:@\[\]]+)(?::([0-9]*))?(/[^?#]*)?(?:\?([^#]*))?(?:#(.*))?$"
USER = r"^(?i:https?)://[^/?#]*@"
MOST_BYTES = 2048
MOST_CHARS = 8192
# Parameters that say where a visitor came from.
TRACKING = "^(utm_.*|gh_src|ref|referrer|source)$"
# Names that are not public, for the work queue and for link checks.
LOCAL_WORK_HOST = r"^(localhost|.*\.localhost|.*\.local)$"
LOCAL_LINK_HOST = r"^(localhost|.*\.internal|.*\.local|.*\.localhost)$"
# Addresses that are not globally routable, by the IANA special-purpose registries.
_BYTE = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"^{_BYTE}(\.{_BYTE}){{3}}$"
NOT_GLOBAL_IPV4 = (
    r"^(0|10|127)\.|^100\.(6[4-9]|[7-9][0-9]|1[01][0-9]|12[0-7])\.|^169\.254\.|^172\.(1[6-9]|2[0-9]|3[01])\.|^192\.0\.0\.([0-8]|1[1-9]|[2-9][0-9]|[12][0-9][0-9])$"
    r"|^192\.0\.2\.|^192\.168\.|^198\.1[89]\.|^198\.51\.100\.|^203\.0\.113\.|^(24[0-9]|25[0-5])\."
)
NOT_GLOBAL_IPV6 = r"^\[(::|0+:|100::|64:ff9b:1:|2001:(db8|[01]?[0-9a-f]{0,2}):|2002:|3fff:|f[cd][0-9a-f]{2}:|fe[89ab][0-9a-f]:)"


def part(url: Column, k: int) -> Column:
    return F.regexp_extract(F.trim(url), PARTS, k)


def scheme(url: Column) -> Column:
    return F.lower(part(url, 1))


def host(url: Column) -> Column:
    return F.lower(part(url, 3))


def token(url: Column) -> Column:
    """The first path segment, in lower case; '' without one."""
    return F.lower(F.regexp_extract(part(url, 5), "^/([^/]+)", 1))


def _port(url: Column, default: Column | None = None) -> Column:
    port = part(url, 4).try_cast("int")
    if default is None:
        default = ((scheme(url) == "http") & (port == 80)) | ((scheme(url) == "https") & (port == 443))
    return F.when(port.isNull() | default, "").otherwise(F.concat(F.lit(":"), port.cast("string")))


def _bad_port(url: Column) -> Column:
    return (part(url, 4) != "") & ~F.coalesce(part(url, 4).try_cast("int") <= 65535, F.lit(False))


def _decoded(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), F.replace(text, F.lit("+"), F.lit(" ")))


def _encoded(text: Column) -> Column:
    """Form encoding that leaves letters, digits and _ . - ~ as they are."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _query(url: Column, drop: str | None = None) -> Column:
    """The decoded parameters in order of name and value, without those whose name matches ``drop``, encoded again."""
    items = F.filter(F.split(part(url, 6), "&"), lambda p: p != "")
    items = F.transform(items, lambda p: F.struct(_decoded(F.regexp_extract(p, "^([^=]*)", 1)).alias("k"), _decoded(F.regexp_extract(p, "^[^=]*=?(.*)$", 1)).alias("v")))
    if drop:
        items = F.filter(items, lambda p: ~F.lower(p["k"]).rlike(drop))
    pairs = F.transform(F.array_sort(items), lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"])))
    return F.when(F.size(pairs) == 0, "").otherwise(F.concat(F.lit("?"), F.array_join(pairs, "&")))


def _trimmed_path(path: Column) -> Column:
    trimmed = F.regexp_replace(path, "/+$", "")
    return F.when(trimmed == "", "/").otherwise(trimmed)


def not_global(host: Column) -> Column:
    """Whether the host is an address that is not globally routable."""
    return (host.rlike(IPV4) & host.rlike(NOT_GLOBAL_IPV4)) | host.rlike(NOT_GLOBAL_IPV6)


def normalize_work_url(url: Column) -> Column:
    """Key of the work queue: public host, default port and last slashes dropped (the root stays), query sorted, fragment dropped; keeps scheme and www."""
    out = F.concat(scheme(url), F.lit("://"), host(url), _port(url), _trimmed_path(part(url, 5)), _query(url))
    bad = (scheme(url) == "") | F.trim(url).rlike(USER) | _bad_port(url) | host(url).rlike(LOCAL_WORK_HOST) | not_global(host(url)) | (F.octet_length(out) > MOST_BYTES)
    return F.when(~bad, out)


def normalize_job_url(url: Column) -> Column:
    """Key of a posting across sources: https, no www., ports 80 and 443 dropped, doubled slashes merged, tracking parameters dropped, query sorted."""
    path = _trimmed_path(F.regexp_replace(part(url, 5), "/{2,}", "/"))
    name = F.regexp_replace(F.regexp_replace(host(url), r"\.+$", ""), r"^www\.", "")
    out = F.concat(F.lit("https://"), name, _port(url, part(url, 4).isin("80", "443")), path, _query(url, TRACKING))
    return F.when((scheme(url) != "") & ~_bad_port(url), out)


def normalize_public_url(url: Column) -> Column:
    """For checking links: ports 80 and 443 only, query order and the path's slashes kept, fragment dropped; no white space or control characters."""
    name = F.regexp_replace(host(url), r"\.+$", "")
    out = F.concat(scheme(url), F.lit("://"), name, _port(url), F.when(part(url, 5) == "", "/").otherwise(part(url, 5)), F.when(part(url, 6) == "", "").otherwise(F.concat(F.lit("?"), part(url, 6))))
    bad = (scheme(url) == "") | F.trim(url).rlike(USER) | ~part(url, 4).isin("", "80", "443") | name.rlike(LOCAL_LINK_HOST) | not_global(name)
    bad = bad | F.trim(url).rlike(r"(?U)[\s\x00-\x1f]") | (F.char_length(F.trim(url)) > MOST_CHARS)
    return F.when(~bad, out)


def origin(url: Column) -> Column:
    return F.when(scheme(url) != "", F.concat(scheme(url), F.lit("://"), host(url), _port(url)))


def parameter(url: Column, name: str) -> Column:
    """A query parameter's decoded value, or null."""
    raw = F.regexp_extract(F.concat(F.lit("&"), part(url, 6)), f"&{name}=([^&]*)", 1)
    return F.nullif(F.try_url_decode(raw), F.lit(""))


def domain_suffixes(domain: Column, least: int = 2) -> Column:
    """The domain and every parent of ``least`` labels or more, for subdomain matches by equality."""
    labels = F.split(domain, r"\.")
    n = F.size(labels)
    return F.when(n >= least, F.transform(F.sequence(F.lit(1), n - (least - 1)), lambda k: F.array_join(F.slice(labels, k, n), "."))).otherwise(F.array(domain))


# First labels of hosts where companies put their job pages.
JOB_HOST_LABELS = "^(apply|career|careers|job|jobs|join)$"


def identity_domain(url: Column) -> Column:
    """Host of a URL, or a bare host, without www. and, of three labels or more, without a first label for job pages."""
    name = F.regexp_replace(F.trim(F.lower(F.coalesce(F.nullif(host(url), F.lit("")), url)), F.lit(".")), r"^www\.", "")
    labels = F.split(name, r"\.")
    job = (F.size(labels) >= 3) & labels[0].rlike(JOB_HOST_LABELS)
    return F.nullif(F.when(job, F.array_join(F.slice(labels, F.lit(2), F.size(labels) - 1), ".")).otherwise(name), F.lit(""))


def domains_compatible(a: Column, b: Column) -> Column:
    """Whether two identity domains are equal or one lies below the other."""
    return (a == b) | F.endswith(a, F.concat(F.lit("."), b)) | F.endswith(b, F.concat(F.lit("."), a))


def board_token(url: Column, api_host: str, board_hosts: list[str]) -> Column:
    """The board's name in a posting site's URL, in lower case: after /v1/boards/ on the API host; on a board host the parameter ``for`` of an embedded
    board, else the first path segment. Null for other hosts, URLs with a user, and names that are not letters, digits, _ and -."""
    path, name = part(url, 5), host(url)
    segment = F.regexp_extract(path, "^/+([^/]+)", 1)
    given = F.regexp_count(F.concat(F.lit("&"), part(url, 6)), F.lit("&for=")) == 1
    embedded = F.when(path.rlike("^/+embed/+(job_board|job_app)/*$|^/+embed/+job_board/+js/*$") & given, parameter(url, "for"))
    found = F.when(name == api_host, F.regexp_extract(path, "^/+v1/+boards/+([^/]+)", 1)).when(segment == "embed", embedded).otherwise(segment)
    found = F.lower(F.coalesce(F.try_url_decode(found), found))
    return F.when(name.isin(api_host, *board_hosts) & ~url.rlike(USER) & found.rlike("^[a-z0-9_-]+$"), found)


def primary_domain(website: Column) -> Column:
    """Host of a website without www.; also reads a bare domain."""
    full = F.when(website.rlike("^(?i)https?://"), website).otherwise(F.concat(F.lit("https://"), website))
    return F.nullif(F.regexp_replace(host(full), r"^www\.", ""), F.lit(""))


def _without_dots(path: Column) -> Column:
    """A path that begins with a slash, with . and .. segments resolved."""

    def step(seen, segment):
        return F.when(segment == ".", seen).when(segment == "..", F.slice(seen, F.lit(1), F.greatest(F.size(seen) - 1, F.lit(1)))).otherwise(F.array_append(seen, segment))

    return F.array_join(F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step), "/")


def resolve_href(base: Column, href: Column) -> Column:
    """The http(s) URL that a link on a page leads to, without fragment, parameters of the last segment and last slashes (the root stays); null for anchors, mail, phone and scripts."""
    link = F.regexp_replace(F.trim(href), "#.*$", "")
    site, path = F.regexp_extract(base, "^(?i:https?)://[^/?#]*", 0), F.regexp_extract(base, "^[a-zA-Z]+://[^/?#]*([^?#]*)", 1)
    folder = F.concat(F.lit("/"), F.regexp_extract(path, "^/(.*/)", 1))
    asked, own = F.regexp_extract(link, r"\?.*$", 0), F.regexp_replace(link, r"\?.*$", "")
    full = (
        F.when(link.rlike("^(?i:https?)://"), link)
        .when(link.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), None)
        .when(F.startswith(link, F.lit("//")), F.concat(F.regexp_extract(base, "^[a-zA-Z]+:", 0), link))
        .when(F.startswith(link, F.lit("/")), F.concat(site, _without_dots(own), asked))
        .when(own == "", F.concat(site, path, asked))
        .otherwise(F.concat(site, _without_dots(F.regexp_replace(F.concat(folder, own), "/{2,}", "/")), asked))
    )
    name, place = F.regexp_extract(full, "^[a-zA-Z]+://([^/?]*)", 1), F.regexp_extract(full, r"^[a-zA-Z]+://[^/?]*([^?]*)", 1)
    query = F.regexp_extract(full, r"\?(.+)$", 0)
    out = F.concat(F.lower(F.regexp_extract(full, "^([a-zA-Z]+)://", 1)), F.lit("://"), name, _trimmed_path(F.regexp_replace(place, ";[^/]*$", "")), query)
    return F.when((link != "") & (site != "") & (name != ""), out)
