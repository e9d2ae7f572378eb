"""Full texts and standard headers of licences, with the variants in which they are given out."""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

_END = "END OF TERMS AND CONDITIONS"
# The Free Software Foundation's addresses over the years.
_ADDRESSES = (
    "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA",
    "51 Franklin Street, Fifth Floor, Boston, MA 02110-1301, USA",
    "51 Franklin St, Fifth Floor, Boston, MA 02110-1301 USA",
    "59 Temple Place, Suite 330, Boston, MA 02111-1307 USA",
    "59 Temple Place - Suite 330, Boston, MA 02111-1307, USA",
    "675 Mass Ave, Cambridge, MA 02139, USA",
)
_SEE = "see <https://www.gnu.org/licenses/>"
_APACHE_HEADER = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
    "with the License. You may obtain a copy of the License at\n\nhttps://www.apache.org/licenses/LICENSE-2.0\n\n"
    'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" '
    "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
    "language governing permissions and limitations under the License."
)
_GPL_HEADER = (
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation{terms}.\n\n"
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    "\n\nYou should have received a copy of the GNU General Public License along with this program; if not, {where}."
)


def _text(name: str) -> str:
    return (Path(__file__).parent / f"{name}.txt").read_text(encoding="utf-8")


def _both_schemes(texts: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Each text with its links as https and as http."""
    for name, text in texts:
        secure = text.replace("http://", "https://")
        yield name, secure
        if "https://" in secure:
            yield name, secure.replace("https://", "http://")


def _apache() -> Iterator[tuple[str, str]]:
    name, whole = "Apache-2.0", _text("Apache-2.0")
    terms = whole[: whole.index(_END)]
    filled = re.sub(r"Copyright \[yyyy\].*", "Copyright 2004 the owner", whole)
    for text in (whole, filled, terms + _END, terms, _APACHE_HEADER):
        yield name, text


def _bsd() -> Iterator[tuple[str, str]]:
    given = _text("BSD-3-Clause")
    given = given[given.index("Redistribution and") :]
    third = given[given.index("3. ") : given.index("THIS SOFTWARE")]
    ends = {
        "BSD-3-Clause": [third.replace("the University", who) for who in ("the University", "the copyright holder", "the author")]
        + [third.replace("Neither the name of the University nor the names of its contributors\n   may be", "The names of its contributors may not be")],
        "BSD-2-Clause": [""],
    }
    titles = {
        "BSD-3-Clause": ("", "BSD 3-Clause License\n\n", "The BSD 3-Clause License\n\n", "BSD-3-Clause\n\n"),
        "BSD-2-Clause": ("", "BSD 2-Clause License\n\n", "The BSD 2-Clause License\n\n", "BSD-2-Clause\n\n"),
    }
    holders = (
        ("REGENTS", "REGENTS"),
        ("COPYRIGHT HOLDERS", "COPYRIGHT HOLDER"),
        ("COPYRIGHT HOLDERS", "COPYRIGHT HOLDERS"),
        ("COPYRIGHT HOLDERS", "COPYRIGHT OWNER"),
    )
    for name, clauses in ends.items():
        for clause in clauses:
            for who, liable in holders:
                text = given.replace(third, clause + "\n" if clause else "\n")
                text = text.replace("BY THE REGENTS", f"BY THE {who}").replace("SHALL THE REGENTS", f"SHALL THE {liable}")
                for body in (text, re.sub(r"(?m)^[123]\. ", "* ", text)):
                    for title in titles[name]:
                        yield name, title + body


def _cc0() -> Iterator[tuple[str, str]]:
    whole = _text("CC0-1.0")
    titled = whole[whole.index("CC0 1.0 Universal") :]
    purpose = whole[whole.index("Statement of Purpose") :]
    for text in (whole, titled, "CC0 1.0 Universal\n\n" + purpose, purpose):
        yield "CC0-1.0", text


def _gpl() -> Iterator[tuple[str, str]]:
    for number in (2, 3):
        name, given = f"GPL-{number}.0-only", _text(f"GPL-{number}.0-only")
        wholes = [given.replace(_ADDRESSES[0], address) for address in _ADDRESSES] if number == 2 else [given]
        if number == 2:
            newest = given.replace(_ADDRESSES[0], "<https://fsf.org/>", 1)
            wholes.append(re.sub(r"if not, write to the Free Software Foundation, Inc\.,\s+51[^\n]*USA", f"if not, {_SEE}", newest))
        for whole in wholes:
            terms = whole[: whole.index(_END)]
            for text in (whole, terms + _END, terms):
                yield name, text
        places = [_SEE, *(f"write to the Free Software Foundation, Inc., {address}" for address in _ADDRESSES)]
        later = f"; either version {number} of the License, or (at your option) any later version"
        exact = (f"; version {number}", f"; version {number} of the License", f"; version {number} only")
        for where in places:
            yield f"GPL-{number}.0-or-later", _GPL_HEADER.format(terms=later, where=where)
            for terms in exact:
                yield name, _GPL_HEADER.format(terms=terms, where=where)


def full_texts() -> tuple[tuple[str, str], ...]:
    """(licence, text) of every full text and standard header."""
    return tuple(pair for texts in (_apache(), _bsd(), _cc0(), _gpl()) for pair in _both_schemes(texts))
