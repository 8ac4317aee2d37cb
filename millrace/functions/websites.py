"""Company websites as evidence of identity: which are safe, their domains, and whether a name fits one."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import text

DOMAIN = r"^(?i)(?=.{1,253}$)(?:[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.)+[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?$"
#: authority, path, query, fragment
_PARTS = r"^(?i:https?)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"
_AUTHORITY = r"^([^:@\[\]]+)(?::([0-9]+))?$"
# Hosts that very many companies share; and the brands whose own root page such a host is.
SHARED_HOSTS = {
    "angel.co": "angellist",
    "apps.apple.com": None,
    "crunchbase.com": "crunchbase",
    "facebook.com": "facebook",
    "github.com": "github",
    "googleblog.blogspot.com": None,
    "itunes.apple.com": None,
    "linkedin.com": "linkedin",
    "lnkd.in": None,
    "m.me": None,
    "pitchbook.com": "pitchbook",
    "play.google.com": None,
    "producthunt.com": "product hunt",
    "substack.com": "substack",
    "ycombinator.com": "y combinator",
}
# Last words of a name that say what kind of company it is; and what domains put before a name.
COMPANY_FORMS = ("incorporated", "corporation", "limited", "corp", "llc", "ltd", "inc")
DOMAIN_PREFIXES = ("get", "go", "hey", "join", "my", "ridewith", "team", "try", "use")


def _authority(website: Column, k: int) -> Column:
    return F.regexp_extract(F.regexp_extract(website, _PARTS, 1), _AUTHORITY, k)


def website_host(website: Column) -> Column:
    """Host of a full URL in lower case, without www.; '' where there is none."""
    return F.regexp_replace(F.lower(_authority(website, 1)), r"^www\.", "")


def company_website(name: Column, website: Column) -> Column:
    """The website, if it is one http(s) URL (or a bare domain, which gets https://) of a host with a name, without a user, on a valid port, and of the company's
    own: a host that companies share counts only as the root page of the brand that it belongs to. Null otherwise."""
    own = F.trim(website)
    full = F.when(own.rlike(DOMAIN), F.concat(F.lit("https://"), own)).when(F.regexp_count(own, F.lit("(?i)https?://")) == 1, own)
    host, port = website_host(full), _authority(full, 2)
    plain_root = F.regexp_extract(full, _PARTS, 2).isin("", "/") & F.regexp_extract(full, _PARTS, 3).isin("", "?") & F.regexp_extract(full, _PARTS, 4).isin("", "#")
    # One pattern and one lookup for all hosts: what an expression is made of is worked out again wherever it stands.
    shared = host.rlike(r"(^|\.)(" + "|".join(map(re.escape, SHARED_HOSTS)) + r")\z")
    brands = F.create_map(*[F.lit(x) for pair in SHARED_HOSTS.items() if pair[1] for x in pair])
    branded = text.normalize_company_name(name) == F.try_element_at(brands, host)
    good = ~own.rlike(r"(?U)\s") & host.rlike(DOMAIN) & ((port == "") | F.coalesce(port.try_cast("int").between(1, 65535), F.lit(False)))
    return F.when(good & (~shared | (F.coalesce(branded, F.lit(False)) & plain_root)), full)


def website_domain(website: Column) -> Column:
    """The domain of a website that ``company_website`` gave."""
    host = website_host(website)
    return F.when(host.rlike(DOMAIN), host)


def name_fits_domain(name: Column, domain: Column) -> Column:
    """Whether the domain's first label is the name, in letters and digits and without a last word for the kind of company, with or without one of DOMAIN_PREFIXES before it."""
    words = F.regexp_extract_all(text.normalize_company_name(name), F.lit("[a-z0-9]+"), 0)
    words = F.when((F.size(words) > 1) & F.element_at(words, -1).isin(*COMPANY_FORMS), F.slice(words, F.lit(1), F.size(words) - 1)).otherwise(words)
    plain, label = F.array_join(words, ""), F.lower(F.regexp_extract(domain, r"^[^.]*", 0))
    before = F.substring(label, F.lit(1), F.length(label) - F.length(plain))
    fits = F.endswith(label, plain) & before.isin("", *DOMAIN_PREFIXES)
    return F.coalesce((plain != "") & (label != "") & fits, F.lit(False))
