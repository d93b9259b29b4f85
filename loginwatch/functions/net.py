"""IPv4 addresses as numbers and IPv6 addresses as hexadecimal text, as SQL text.

Nearly all addresses of a log are IPv4: their number is plain arithmetic in generated
code. The 32 digits of the others order and cut like the address: the network under a
mask is a prefix of them, the last digit masked.
"""

from __future__ import annotations

OCTETS = r"split({address}, '\\.')"


def ipv4_number(address: str) -> str:
    """A dotted quad as BIGINT; NULL for NULL, IPv6 and malformed text.

    Parts are cut off without arrays, so that all of it stays in generated code.
    """
    heads = [f"substring_index({address}, '.', {i + 1})" for i in range(4)]
    parts = [f"try_cast(substring_index({h}, '.', -1) AS int)" for h in heads]
    valid = " AND ".join(f"{p} BETWEEN 0 AND 255" for p in parts)
    number = " + ".join(f"{p} * {256 ** (3 - i)}L" for i, p in enumerate(parts))
    return f"CASE WHEN length({address}) - length(replace({address}, '.', '')) = 3 AND {valid} THEN {number} END"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``value`` under a name, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def ipv4_bits(address: str) -> str:
    return f"lower(lpad(hex({ipv4_number(address)}), 8, '0'))"


def ipv6_bits(address: str) -> str:
    """``::`` is filled with zeros and a dotted quad at the end counts as two groups."""
    tail = "substring_index(a, ':', -1)"
    quad = f"concat(substring(q, 1, 4), ':', substring(q, 5, 4))"
    plain = _let(
        "a", f"lower({address})",
        f"if(instr(a, '.') = 0, a, {_let('q', ipv4_bits(tail), f'concat(left(a, length(a) - length({tail})), {quad})')})",
    )
    groups = (
        "if(size(h) = 1, split(h[0], ':'), concat("
        "if(h[0] = '', array(), split(h[0], ':')),"
        " array_repeat('0', 8 - if(h[0] = '', 0, size(split(h[0], ':'))) - if(h[1] = '', 0, size(split(h[1], ':')))),"
        " if(h[1] = '', array(), split(h[1], ':'))))"
    )
    valid = "size(g) = 8 AND forall(g, x -> x RLIKE '^[0-9a-f]{1,4}$')"
    joined = f"if({valid}, array_join(transform(g, x -> lpad(x, 4, '0')), ''), NULL)"
    whole = _let("h", f"split({plain}, '::')", f"if(size(h) > 2, NULL, {_let('g', groups, joined)})")
    # With ``::`` at most seven groups are written, else the fill is empty and a ninth would fit.
    return f"if(instr({address}, ':::') > 0 OR ({address} LIKE '%::%' AND size(split({address}, ':')) > 9), NULL, {whole})"


def address_bits(address: str) -> str:
    """Hexadecimal digits of an address; NULL for NULL and malformed text."""
    return f"if(instr({address}, ':') > 0, {ipv6_bits(address)}, {ipv4_bits(address)})"


def network(bits: str, width: str | int) -> str:
    """The digits of the network of ``bits`` under a mask of ``width`` bits, host bits cleared."""
    digits = "0123456789abcdef"
    masked = " ".join(
        f"WHEN {r} THEN translate(substring({bits}, {width} div 4 + 1, 1), '{digits}',"
        f" '{''.join(digits[i - i % (1 << (4 - r))] for i in range(16))}')" for r in (1, 2, 3)
    )
    return f"concat(substring({bits}, 1, int({width} div 4)), CASE {width} % 4 {masked} ELSE '' END)"


#: Widths of both families in one number: IPv4 masks from 4000, IPv6 masks from 6000.
FAMILIES = {4: 32, 6: 128}


def cidr_code(cidr: str) -> str:
    """Family and width of a CIDR text as one number; NULL unless the width is one."""
    text = f"substring_index({cidr}, '/', -1)"
    number = f"if(size(split({cidr}, '/')) = 2 AND {text} RLIKE '^[0-9]{{1,3}}$', cast({text} AS int), NULL)"
    return _let("w", number, f"CASE WHEN instr({cidr}, ':') > 0 THEN if(w <= 128, 6000 + w, NULL) WHEN w <= 32 THEN 4000 + w END")


def cidr_base(cidr: str, code: str) -> str:
    """Network of a CIDR text, given its code, in the form of :func:`network_of`."""
    address = f"substring_index({cidr}, '/', 1)"
    four = f"cast(shiftright({ipv4_number(address)}, 4032 - {code}) AS string)"
    six = _let("b", ipv6_bits(address), network("b", f"({code} - 6000)"))
    return f"CASE WHEN {code} < 6000 THEN {four} WHEN instr({cidr}, ':') > 0 THEN {six} END"


def network_of(number: str, bits: str, code: int) -> str:
    """Network of an address under a coded mask, given its number if it is IPv4 and its
    digits if it is IPv6; NULL for one of the other family."""
    if code < 6000:
        return f"cast(shiftright({number}, {4032 - code}) AS string)"
    return network(bits, code - 6000)


def order_key(number: str, bits: str) -> str:
    """Text that orders addresses as their bits do, IPv4 before IPv6."""
    return f"coalesce(concat('4', lower(lpad(hex({number}), 8, '0'))), concat('6', {bits}))"


def range_ends(network_key: str, code: str) -> tuple[str, str]:
    """Order keys of the first and the last address of a range, from its network and code."""
    digits = "0123456789abcdef"
    filled = " ".join(
        f"WHEN {r} THEN concat(left({network_key}, length({network_key}) - 1), translate(right({network_key}, 1), '{digits}',"
        f" '{''.join(digits[i | (1 << (4 - r)) - 1] for i in range(16))}'))" for r in (1, 2, 3)
    )
    first = f"shiftleft(cast({network_key} AS bigint), 4032 - {code})"
    size = f"shiftleft(1L, 4032 - {code})"
    four = [order_key(n, "NULL") for n in (first, f"({first} + {size} - 1)")]
    last = f"CASE ({code} - 6000) % 4 {filled} ELSE {network_key} END"
    six = [f"concat('6', rpad({network_key}, 32, '0'))", f"concat('6', rpad({last}, 32, 'f'))"]
    return tuple(f"CASE WHEN {code} < 6000 THEN {a} ELSE {b} END" for a, b in zip(four, six))


def leading_octets(address: str, octets: int) -> str:
    """``a.b.c.`` style prefix text; NULL unless more follows the first ``octets`` parts."""
    return (
        f"if(size({OCTETS.format(address=address)}) > {octets},"
        f" concat(substring_index({address}, '.', {octets}), '.'), NULL)"
    )
