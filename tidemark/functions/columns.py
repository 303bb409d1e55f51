"""Column builders: dimensions, ratios, comparison and interval outcomes, scores, geometry, validation."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What identifiers look like, and how comparison operators are spelled.
SAFE_ID = r"^[A-Za-z0-9][A-Za-z0-9._:-]{0,127}\z"
OPERATORS = (">=", "<=", ">", "<", "==")


def even_dimensions(width: Column, height: Column, target: int) -> tuple[Column, Column]:
    """Width up to ``target`` and the height in proportion (half to even), both even, the height at least 2."""
    w = F.least(width, F.lit(target))
    w = w - w % 2
    h = F.bround(height.cast("double") * w / width).cast("long")
    return w, F.greatest(h - h % 2, F.lit(2))


def ratio(text: Column) -> Column:
    """A rational such as 30000/1001; 0 where it can't be read."""
    parts = F.split(text, "/")
    top = F.try_divide(parts[0].try_cast("double"), F.coalesce(F.get(parts, F.lit(1)), F.lit("1")).try_cast("double"))
    return F.coalesce(top, F.lit(0.0))


def compare(value: Column, operator: Column, threshold: Column) -> Column:
    return (
        F.when(operator == ">=", value >= threshold).when(operator == "<=", value <= threshold)
        .when(operator == ">", value > threshold).when(operator == "<", value < threshold).when(operator == "==", value == threshold)
    )


def rule_outcome(value: Column, is_bool: Column, operator: Column, threshold: Column, low: Column, high: Column) -> Column:
    """pass, fail or uncertain: by the interval where there is one, but by the value alone for booleans and for ``==``."""
    point = F.when(compare(value, operator, threshold), "pass").otherwise("fail")
    sure = F.when(operator == ">=", low >= threshold).when(operator == "<=", high <= threshold).when(operator == ">", low > threshold).otherwise(high < threshold)
    never = F.when(operator == ">=", high < threshold).when(operator == "<=", low > threshold).when(operator == ">", high <= threshold).otherwise(low >= threshold)
    by_interval = F.when(sure, "pass").when(never, "fail").otherwise("uncertain")
    return F.when(is_bool | (operator == "==") | low.isNull() | high.isNull(), point).otherwise(by_interval)


def black_deficit(mean: Column, entropy: Column, most_mean: float, most_entropy: float) -> Column:
    return F.greatest((most_mean - mean) / max(most_mean, 1), (most_entropy - entropy) / max(most_entropy, 1))


def iou(a: Column, b: Column, epsilon: float = 1e-9) -> Column:
    """Intersection over union of boxes (x1, y1, x2, y2). ``epsilon`` is added to the union, as suppression does; with 0, as matching has
    it, boxes without area have 0."""
    side = lambda lo, hi: F.greatest(F.lit(0.0), hi - lo)
    area = lambda x: side(x["x1"], x["x2"]) * side(x["y1"], x["y2"])
    shared = side(F.greatest(a["x1"], b["x1"]), F.least(a["x2"], b["x2"])) * side(F.greatest(a["y1"], b["y1"]), F.least(a["y2"], b["y2"]))
    union = area(a) + area(b) - shared
    return shared / (union + F.lit(epsilon)) if epsilon else F.when(union > 0, shared / union).otherwise(0.0)


def suppressed(boxes: Column, threshold: float) -> Column:
    """Greedy non-maximum suppression of an array of boxes with scores, best first (the later of equals)."""
    placed = F.transform(boxes, lambda b, i: F.struct((-b["score"]).alias("s"), (-i).alias("i"), b.alias("b")))
    empty = F.filter(boxes, lambda b: F.lit(False))
    return F.aggregate(F.transform(F.array_sort(placed), lambda x: x["b"]), empty, lambda kept, b: F.when(F.exists(kept, lambda k: iou(k, b) > threshold), kept).otherwise(F.concat(kept, F.array(b))))


def stripped(text: Column) -> Column:
    """Without white space at its ends."""
    return F.regexp_replace(text, r"^\s+|\s+\z", "")


def normalised_key(key: Column) -> Column:
    return F.ltrim(stripped(key), F.lit("/"))


def normalised_etag(etag: Column) -> Column:
    return F.trim(stripped(etag), F.lit('"'))


def safe_prefix(prefix: Column) -> tuple[Column, Column]:
    """The prefix with one slash at its end, and whether it is safe: not empty, without a segment that leads upwards."""
    bare = normalised_key(prefix)
    return F.concat(F.rtrim(bare, F.lit("/")), F.lit("/")), (bare != "") & ~F.array_contains(F.split(bare, "/"), "..")


def valid_key(key: Column) -> Column:
    k = normalised_key(key)
    return (k != "") & ~F.exists(F.split(k, "/"), lambda s: s.isin("", ".", "..")) & ~k.rlike("[\r\n\t]")


def valid_id(name: Column) -> Column:
    return name.rlike(SAFE_ID)


def https_host(url: Column) -> Column:
    return F.coalesce((F.try_parse_url(url, F.lit("PROTOCOL")) == "https") & (F.try_parse_url(url, F.lit("HOST")) != ""), F.lit(False))


#: IPv4 networks that aren't public (first address, bits of the network).
PRIVATE_NETWORKS = (
    ("0.0.0.0", 8), ("10.0.0.0", 8), ("100.64.0.0", 10), ("127.0.0.0", 8), ("169.254.0.0", 16), ("172.16.0.0", 12), ("192.0.0.0", 24), ("192.0.2.0", 24),
    ("192.168.0.0", 16), ("198.18.0.0", 15), ("198.51.100.0", 24), ("203.0.113.0", 24), ("240.0.0.0", 4),
)


def ipv4_number(address: Column) -> Column:
    """A dotted address as a number; null for anything else."""
    parts = F.transform(F.split(address, r"\."), lambda x: x.cast("long"))
    ok = address.rlike(r"^(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)\z")
    return F.when(ok, F.aggregate(parts, F.lit(0).cast("long"), lambda acc, x: acc * 256 + x))


def public_ipv4(address: Column) -> Column:
    """Whether a dotted address lies in none of the networks above; null for anything else, as a name must be resolved first."""
    n = ipv4_number(address)
    number = lambda a: sum(int(x) << s for x, s in zip(a.split("."), (24, 16, 8, 0)))
    private = F.lit(False)
    for first, bits in PRIVATE_NETWORKS:
        private |= n.between(number(first), number(first) + (1 << (32 - bits)) - 1)
    return F.when(n.isNotNull(), ~private)


#: IPv6 networks that aren't public, and the parts of them that are (first address in full groups, bits of the network); single IPv4
#: addresses that are public within a network that isn't.
PRIVATE_NETWORKS_6 = (
    ("0:0:0:0:0:0:0:0", 128), ("0:0:0:0:0:0:0:1", 128), ("64:ff9b:1:0:0:0:0:0", 48), ("100:0:0:0:0:0:0:0", 64), ("2001:0:0:0:0:0:0:0", 23), ("2001:db8:0:0:0:0:0:0", 32),
    ("2002:0:0:0:0:0:0:0", 16), ("fc00:0:0:0:0:0:0:0", 7), ("fe80:0:0:0:0:0:0:0", 10),
)
PUBLIC_WITHIN_6 = (
    ("2001:1:0:0:0:0:0:1", 128), ("2001:1:0:0:0:0:0:2", 128), ("2001:3:0:0:0:0:0:0", 32), ("2001:4:112:0:0:0:0:0", 48), ("2001:20:0:0:0:0:0:0", 28), ("2001:30:0:0:0:0:0:0", 28),
)
PUBLIC_WITHIN_4 = ("192.0.0.9", "192.0.0.10")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


_DOTTED = r"^(.*:)(\d+\.\d+\.\d+\.\d+)\z"


def ipv6_groups(address: Column) -> Column:
    """The eight groups of an address as numbers, with one run of zeros left out and the last two as dotted numbers or not; null for anything else."""
    none = F.array().cast("array<string>")
    hex_ = lambda v: F.lower(F.hex(v.cast("long")))
    start, tail = F.regexp_extract(address, _DOTTED, 1), ipv4_number(F.regexp_extract(address, _DOTTED, 2))
    plain = F.when(start != "", _let(tail, lambda n: F.concat(start, hex_(F.floor(n / 65536)), F.lit(":"), hex_(n % 65536)))).otherwise(address)
    cut = lambda t: F.when(t == "", none).otherwise(F.split(t, ":"))

    def parts(text: Column) -> Column:
        runs = F.size(F.split(text, "::")) - 1
        return F.struct(cut(F.substring_index(text, "::", 1)).alias("left"), F.when(runs == 1, cut(F.substring_index(text, "::", -1))).otherwise(none).alias("right"), F.when(~text.contains(":::"), runs).alias("runs"))

    def filled(p: Column) -> Column:
        missing = F.lit(8) - F.size(p["left"]) - F.size(p["right"])
        return F.when((p["runs"] == 1) & (missing > 0), F.concat(p["left"], F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), p["right"])).when((p["runs"] == 0) & (missing == 0), p["left"])

    sound = lambda g: F.coalesce(F.forall(g, lambda x: x.rlike(r"^[0-9A-Fa-f]{1,4}\z")), F.lit(False))
    return _let(_let(_let(plain, parts), filled), lambda g: F.when(sound(g), F.transform(g, lambda x: F.conv(x, 16, 10).cast("long"))))


def _halves(groups: Column) -> Column:
    """An address's upper and lower 64 bits."""
    half = lambda first: F.aggregate(F.slice(groups, first, 4), F.lit(0).cast("long"), lambda acc, g: F.call_function("shiftleft", acc, F.lit(16)).bitwiseOR(g))
    return F.struct(half(1).alias("upper"), half(5).alias("lower"))


def _in_network_6(halves: Column, first: str, bits: int) -> Column:
    number, mask = sum(int(g, 16) << (112 - 16 * k) for k, g in enumerate(first.split(":"))), ((1 << bits) - 1) << (128 - bits)
    signed = lambda v: F.lit((v + (1 << 63)) % (1 << 64) - (1 << 63)).cast("long")
    same = lambda c, v, m: c.bitwiseAND(signed(m)) == signed(v & m)
    low = (1 << 64) - 1
    return same(halves["upper"], number >> 64, mask >> 64) & same(halves["lower"], number & low, mask & low)


def public_address(address: Column) -> Column:
    """Whether an IPv4 or IPv6 address is a public one, an IPv4 address that is mapped into IPv6 by itself; null for anything else."""
    four = lambda a: public_ipv4(a) | a.isin(*PUBLIC_WITHIN_4)
    dotted = lambda n: F.concat_ws(".", *(F.floor(n / (1 << s)) % 256 for s in (24, 16, 8, 0)))

    def six(h: Column) -> Column:
        inside = lambda networks: functools.reduce(Column.__or__, (_in_network_6(h, n, b) for n, b in networks))
        mapped = _in_network_6(h, "0:0:0:0:0:ffff:0:0", 96)
        own = ~inside(PRIVATE_NETWORKS_6) | inside(PUBLIC_WITHIN_6)
        return F.when(mapped, _let(dotted(h["lower"].bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))), four)).otherwise(own)

    return F.coalesce(four(address), _let(ipv6_groups(address), lambda g: F.when(g.isNotNull(), _let(_halves(g), six))))


def evidence_name(index: Column, reason: Column, t: Column) -> Column:
    """The file name of a piece of evidence: its place, its reason with safe characters only, its time."""
    return F.format_string("%02d-%s-%.3f.jpg", index, F.regexp_replace(reason, r"[^\p{L}\p{N}_-]", "-"), t)


def safe_artifact_id(name: Column) -> Column:
    """Whether a name stays a direct child of the folder that it is looked up in."""
    return F.coalesce((name != "") & ~name.contains("/") & ~name.isin(".", ".."), F.lit(False))


def object_key(prefix: Column, job: Column, item: Column, *rest: Column) -> Column:
    return F.concat(prefix, F.concat_ws("/", job, F.lit("items"), item, *rest))
