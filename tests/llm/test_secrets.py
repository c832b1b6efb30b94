"""Private keys as they stand in mails, program text and configuration."""

import json
import textwrap

import pytest

from docstrata.llm import secrets
from test_texts import B64, KEY, SSH, der

PBES2 = der(0x30, der(6, bytes.fromhex("2a864886f70d01050d")), der(0x30, der(4, b"salt" * 4)))
SEALED = der(0x30, PBES2, der(4, bytes(range(64))))
OTHER = der(0x30, der(0x30, der(6, bytes.fromhex("2b0601"))), der(4, bytes(80)))
DIGEST = der(0x30, der(0x30, der(6, bytes.fromhex("608648016503040201")), der(5)), der(4, bytes(range(64))))
LONG = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2a\x86\x48")), der(4, bytes(range(256)) * 2))
WRAP = lambda x, n=64: "\n".join(textwrap.wrap(x, n))
PEM = lambda x, kind="PRIVATE KEY": f"-----BEGIN {kind}-----\n{x}\n-----END {kind}-----"
CIPHER = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00112233445566778899AABBCCDDEEFF\n\n"


@pytest.mark.parametrize("text, kind", [
    (PEM(CIPHER + WRAP(B64(bytes(range(7, 167)))), "RSA PRIVATE KEY"), "pem"),
    (PEM(f"Comment: a-b: c\n\n{WRAP(B64(LONG))}"), "pem"),
    (PEM(WRAP(B64(SEALED)), "ENCRYPTED PRIVATE KEY"), "pem"), (B64(SEALED), "der"), (B64(OTHER), "der"),
    (json.dumps(PEM(WRAP(B64(LONG))))[1:-1], "pem"), (json.dumps(json.dumps(PEM(WRAP(B64(LONG)))))[3:-3], "pem"),
    (WRAP(B64(LONG)), "der"), (WRAP(B64(LONG)).replace("\n", "\r\n  "), "der"), (WRAP(B64(LONG), 76), "der"), (json.dumps(WRAP(B64(LONG)))[1:-1], "der"),
    (WRAP(B64(SSH)), "openssh"), (B64(PEM(WRAP(B64(LONG))).encode()), "pem"), (WRAP(B64(PEM(WRAP(B64(LONG))).encode()), 76), "pem"),
    (B64(f"Bag\n{PEM(WRAP(B64(KEY)))}\n".encode()), "pem"), (PEM(WRAP(B64(LONG))).encode().hex(), "pem"),
])
def test_keys_are_found_whole(text, kind):
    for before, after in (("see ñ ", " end"), ("a line\n", "\nword"), ('"\\n', '\\n" and')):
        framed = f"{before}{text}{after}"
        spans = [s for s in secrets.scan_text(framed)[4].split(",") if not s.startswith(("hex", "assign", "access"))]
        assert f"{kind}:{len(before)}:{len(before) + len(text)}" in spans and len(spans) == 1
        assert secrets.redacted_text(framed) == f"{before}[redacted]{after}"


@pytest.mark.parametrize("text", [
    B64(DIGEST), WRAP(B64(LONG[:-1])), WRAP(B64(bytes(range(200)))), PEM(CIPHER + WRAP(B64(bytes(161))), "RSA PRIVATE KEY"),
    PEM(CIPHER), B64(PEM(WRAP(B64(LONG[:-1]))).encode()), PEM(f"Comment: x\n\n{B64(LONG[:-2])}"),
])
def test_what_is_no_key_stays(text):
    assert secrets.redacted_text(f"see {text} end") == f"see {text} end"
