"""URL helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wareloom.schemas import NOT_AVAILABLE


def store_name(base_url: Column) -> Column:
    """Host up to its first dot, without the scheme and a leading www."""
    bare = F.replace(base_url, F.lit("https://www."), F.lit(""))
    bare = F.replace(bare, F.lit("https://"), F.lit(""))
    return F.substring_index(bare, ".", 1)


def product_link(base_url: Column, handle: Column) -> Column:
    link = F.concat(base_url, F.lit("/products/"), handle)
    return F.when(F.coalesce(handle, F.lit("")) != "", link).otherwise(NOT_AVAILABLE)


# --- Fixed values: schemes whose references may be relative, and those whose last segment may have parameters. ---
RELATIVE = ("", "file", "ftp", "gopher", "http", "https", "imap", "mms", "nntp", "prospero", "rtsp", "rtsps", "rtspu",
            "sftp", "shttp", "svn", "svn+ssh", "wais", "ws", "wss")
WITH_PARAMETERS = ("", "ftp", "hdl", "http", "https", "mms", "prospero", "rtsp", "rtsps", "rtspu", "sftp", "shttp",
                   "sip", "sips", "tel")
# ----------------------------------------------------------------------------------------------------------------
SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
SITE = r"^//([^/?#]*)"
PARAMETERS = r"(?s)^((?:.*/)?[^;/]*);([^/]*)\z"
#: A site with brackets is one of an IPv6 address, or it is no URL.
BRACKETED = r"^[^\[\]]*\[(?:[vV][0-9A-Fa-f]+\..+|(?=[^\]]*:)[0-9A-Fa-f:.]+(?:%[^\]]*)?)\]"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _parsed(url: Column, scheme: Column) -> Column:
    """``scheme, site, path, parameters, query, fragment, valid`` of a URL; what is not there is empty."""
    plain = F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")

    def after_site(u: Column) -> Column:
        path, site = F.regexp_extract(u["rest"], "^[^?#]*", 0), u["site"]
        has = u["scheme"].isin(*WITH_PARAMETERS) & path.rlike(PARAMETERS)
        return F.struct(
            u["scheme"].alias("scheme"), site.alias("site"),
            F.when(has, F.regexp_extract(path, PARAMETERS, 1)).otherwise(path).alias("path"),
            F.when(has, F.regexp_extract(path, PARAMETERS, 2)).otherwise("").alias("parameters"),
            F.regexp_extract(u["rest"], r"(?s)^[^?#]*\?([^#]*)", 1).alias("query"),
            F.regexp_extract(u["rest"], r"(?s)^[^#]*#(.*)\z", 1).alias("fragment"),
            (~site.rlike(r"[\[\]]") | site.rlike(BRACKETED)).alias("valid"))

    def after_scheme(u: Column) -> Column:
        return _let(F.struct(u["scheme"].alias("scheme"), F.regexp_extract(u["rest"], SITE, 1).alias("site"),
                             F.regexp_replace(u["rest"], SITE, "").alias("rest")), after_site)

    def after_blanks(u: Column) -> Column:
        named = F.lower(F.regexp_extract(u, SCHEME, 1))
        return _let(F.struct(F.when(named != "", named).otherwise(scheme).alias("scheme"),
                             F.regexp_replace(u, SCHEME, "").alias("rest")), after_scheme)

    return _let(plain, after_blanks)


def _unparsed(scheme: Column, site: Column, path: Column, parameters: Column, query: Column, fragment: Column) -> Column:
    with_parameters = F.when(parameters != "", F.concat(path, F.lit(";"), parameters)).otherwise(path)

    def joined(path: Column) -> Column:
        rooted = F.when((path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
        bare = (path.startswith("//")) | ((scheme != "") & ((path == "") | path.startswith("/")))
        located = F.when(site != "", F.concat(F.lit("//"), site, rooted)).when(bare, F.concat(F.lit("//"), path)).otherwise(path)
        return F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""), located,
                        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
                        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""))

    return _let(with_parameters, joined)


def _without_dots(base_path: Column, path: Column) -> Column:
    """``path`` as seen from ``base_path``; each ``..`` takes the segment before it away."""
    parts = F.split(base_path, "/", -1)
    # The last segment of the base goes, unless it is empty; then it falls away with the empty ones in between.
    above = F.when(F.element_at(parts, -1) != "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    # Only where the two meet do empty segments fall away.
    met = F.concat(above, F.split(path, "/", -1))
    inner = F.filter(F.slice(met, 2, F.greatest(F.size(met) - 2, F.lit(0))), lambda s: s != "")
    dense = F.when(F.size(met) == 1, met).otherwise(F.concat(F.slice(met, 1, 1), inner, F.slice(met, -1, 1)))
    segments = F.when(path.startswith("/"), F.split(path, "/", -1)).otherwise(dense)

    def resolved(every: Column) -> Column:
        stack = F.aggregate(every, F.array().cast("array<string>"), lambda kept, s:
                            F.when(s == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0))))
                            .when(s == ".", kept).otherwise(F.concat(kept, F.array(s))))
        ends = F.element_at(every, -1).isin(".", "..")
        text = F.array_join(F.when(ends, F.concat(stack, F.array(F.lit("")))).otherwise(stack), "/")
        return F.when(text == "", "/").otherwise(text)

    return _let(segments, resolved)


def _joined(base: Column, href: Column) -> Column:
    def with_link(b: Column) -> Column:
        def combined(u: Column) -> Column:
            own_site = u["site"] != ""
            same_page = (u["path"] == "") & (u["parameters"] == "")
            site = F.when(own_site, u["site"]).otherwise(b["site"])
            path = (
                F.when(own_site, u["path"]).when(same_page, b["path"])
                .otherwise(_without_dots(b["path"], u["path"])))
            parameters = F.when(~own_site & same_page, b["parameters"]).otherwise(u["parameters"])
            query = F.when(~own_site & same_page & (u["query"] == ""), b["query"]).otherwise(u["query"])
            whole = _unparsed(u["scheme"], site, path, parameters, query, u["fragment"])
            foreign = (u["scheme"] != b["scheme"]) | ~u["scheme"].isin(*RELATIVE) | ~u["valid"] | ~b["valid"]
            return F.when(foreign, href).otherwise(whole)
        return _let(_parsed(href, b["scheme"]), combined)
    return _let(_parsed(base, F.lit("")), with_link)


def resolve_url(base: Column, href: Column) -> Column:
    """Resolve ``href`` against the page it was found on, as Python's ``urljoin`` does; a malformed one stays as it is.

    Plain root-relative paths, by far the most frequent, only take the page's site.
    """
    site = F.regexp_extract(base, r"^https?://[^/?#\\\[\]\s]+(?=[/?#]|\z)", 0)
    plain = (site != "") & href.rlike(r"^/(?:[^/\\?#;\s.]+/)*[^/\\?#;\s.]*\z")
    return (
        F.when(base.isNull() | href.isNull(), F.lit(None).cast("string"))
        .when(plain, F.concat(site, href)).when(base == "", href).when(href == "", base).otherwise(_joined(base, href)))
