import re
import textwrap

from propensity.llm import license_scan as L

from .test_license_scan import PROSE, scan


def rewrapped(text):
    return "Copyright (c) 2020 Somebody Else\n\n" + "\n\n".join(textwrap.fill(p, 60) for p in re.split(r"\n\s*\n", text))


def test_full_licences_are_licence_files_and_inherited(spark):
    rows = [(f"{n}/{k}/17", t) for n, text in L.full_texts() for k, t in (("as-is", text), ("wrapped", rewrapped(text)))]
    rows += [(f"{n}/as-is/sub/18", PROSE) for n, _ in L.full_texts()] + [(f"p/{k}", PROSE * 3) for k in range(40)]
    got = scan(spark, rows)
    for name, _ in L.full_texts():
        for k in ("as-is", "wrapped"):
            row = got[f"{name}/{k}/17"]
            assert (row["own_license"], row["license_file"]) == (name, True), (name, k)
        assert got[f"{name}/as-is/sub/18"]["license"] == name
    assert all(got[f"p/{k}"]["license"] is None for k in range(40))


def test_spdx_lines_and_wrapped_headers(spark):
    header = ("/*\n * This Source Code Form is subject to the terms of\n * the Mozilla Public License,\n"
              " * v. 2.0.\n */\nint x;\n")
    got = scan(spark, [
        ("a", f"# SPDX-License-Identifier: MIT\n{PROSE}"), ("b", f"// SPDX-License-Identifier: GPL-2.0-or-later\n{PROSE}"),
        ("c", f"/* SPDX-License-Identifier: (MIT OR Apache-2.0) */\n{PROSE}"), ("d", header + PROSE),
        ("e", "# SPDX-License-Identifier: GPL-3.0-only WITH Classpath-exception-2.0\n"), ("f", PROSE)])
    assert {p: r["own_license"] for p, r in got.items()} == {
        "a": "MIT", "b": "GPL-2.0", "c": "Apache-2.0", "d": "MPL-2.0", "e": "GPL-3.0", "f": None}
