"""Link normalisation and what links tell."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakesieve.functions.bind import bind
from lakesieve.functions.text import clean, strip

# The path markers that an act's code follows, in the order in which they are tried.
MARKERS = ("solicitud-de-cotizacion", "pliego-de-cargos", "acto-publico", "licitacion")


def unquote(c: Column) -> Column:
    """Percent-decoding; a plus stays a plus, and what can't be decoded stays as it is."""
    return bind(lambda s: F.coalesce(F.try_url_decode(F.replace(s["c"], F.lit("+"), F.lit("%2B"))), s["c"]), c=c)


def _parts(c: Column, host: str, use) -> Column:
    """use(net, path, fragment) of a link; each is worked out once."""
    scheme = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
    path = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"

    def split(s: Column) -> Column:
        u = s["u"]
        return bind(
            lambda p: use(F.when(p["net"] == "", host).otherwise(p["net"]), p["path"], p["fragment"]),
            net=F.lower(F.regexp_extract(u, scheme, 1)),
            path=F.regexp_replace(F.regexp_extract(u, path, 1), ";[^/]*$", ""),
            fragment=F.regexp_extract(u, r"#(.*)$", 1),
        )

    # a link that begins with a slash is one of the portal's
    return bind(split, u=F.regexp_replace(strip(F.coalesce(c, F.lit(""))), "^(?=/)", f"https://{host}"))


def _squeeze(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(unquote(c), "/{2,}", "/"), "/+$", "")


def normalize_url(c: Column, host: str = "www.portal.example", domain: str = "portal.example", drop_token: bool = False) -> Column:
    """https, lower-case host (with www. on the portal's domain), squeezed path, no query, lower-case fragment.

    drop_token: a last fragment part that looks generated goes, if a marker leads the fragment.
    """
    def kept(f: Column) -> Column:
        """The fragment without a generated end."""
        def cut(s: Column) -> Column:
            part, tail = s["part"], F.try_element_at(s["part"], F.lit(-1))
            drop = (F.size(part) >= 3) & F.get(part, F.lit(0)).isin(*MARKERS) & (F.length(tail) >= 12) & tail.rlike("^[a-z0-9_=]+$")
            return F.when(drop, F.concat(F.lit("/"), F.array_join(F.slice(part, 1, F.size(part) - 1), "/"))).otherwise(f)

        return bind(cut, part=F.filter(F.split(f, "/"), lambda x: x != "")) if drop_token else f

    def out(net: Column, path: Column, fragment: Column) -> Column:
        www = F.when(net.endswith(domain) & ~net.startswith("www."), F.concat(F.lit("www."), net)).otherwise(net)
        whole = F.concat(F.lit("https://"), www, F.coalesce(F.nullif(_squeeze(path), F.lit("")), F.lit("/")))
        return bind(lambda s: F.concat(whole, F.coalesce(F.concat(F.lit("#"), F.nullif(kept(s["f"]), F.lit(""))), F.lit(""))), f=F.lower(_squeeze(fragment)))

    return F.when(strip(F.coalesce(c, F.lit(""))) == "", "").otherwise(_parts(c, host, out))


def act_key(c: Column, host: str = "www.portal.example") -> Column:
    """marker:CODE of the first marker that is found; else acto:CODE for a code of four groups; else empty."""
    def key(s: Column) -> Column:
        tried = [F.concat(F.lit(f"{m}:"), F.nullif(F.upper(strip(F.regexp_extract(s["t"], f"/{m}/([^/?#]+)", 1))), F.lit(""))) for m in MARKERS]
        other = F.concat(F.lit("acto:"), F.nullif(F.upper(F.regexp_extract(s["t"], r"/(\d{4}(?:-[a-z0-9]+){3,})", 1)), F.lit("")))
        return F.coalesce(*tried, other, F.lit(""))

    def text(net: Column, path: Column, fragment: Column) -> Column:
        return bind(key, t=F.regexp_replace(F.lower(F.concat(unquote(path), F.lit("/"), unquote(fragment))), "/{2,}", "/"))

    return _parts(c, host, text)


def expected_code(c: Column) -> Column:
    return F.split_part(act_key(c), F.lit(":"), F.lit(2))


def process_code(c: Column) -> Column:
    u = clean(c)
    tried = [F.nullif(F.regexp_extract(u, f"(?i)/{m}/([^/]+)/", 1), F.lit("")) for m in ("pliego-de-cargos", "solicitud-de-cotizacion")]
    return F.coalesce(*tried, F.lit(""))


def abs_url(c: Column, base: str = "https://www.portal.example") -> Column:
    def whole(s: Column) -> Column:
        u = s["u"]
        return F.when((u == "") | u.rlike("^https?://"), u).otherwise(F.concat(F.lit(base), F.when(u.startswith("/"), "").otherwise("/"), u))

    return bind(whole, u=clean(c))


def first_href(html: Column, holds: str, without: str = "", base: str = "https://www.portal.example") -> Column:
    """The first link of a page that holds one text and not another."""
    found = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit("(?i)(?:href|data-uw-original-href)=[\"']([^\"']+)[\"']"), 1)
    fits = F.filter(found, lambda h: (F.trim(h) != "") & F.lower(h).contains(holds.lower()) & (~F.lower(h).contains(without.lower()) if without else F.lit(True)))
    return F.coalesce(abs_url(F.get(fits, F.lit(0)), base), F.lit(""))
