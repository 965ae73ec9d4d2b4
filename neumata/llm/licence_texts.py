"""Public licence texts and notices, the names of licences in statements, and their identifiers.

Of long licences this is the notice that goes into files; of short ones the whole text
without its copyright line.
"""

from __future__ import annotations

MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so"""
AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution.
"""
BSD_NAME = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived
from this software without specific prior written permission.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT
NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""


def gnu(what: str, licence: str, version: str, later: bool, end: str) -> str:
    """The notice of a GNU licence."""
    terms = f"either version {version} of the License, or (at your option) any later version." if later else f"version {version} of the License."
    return f"""{what} is free software; you can redistribute it and/or modify it under the terms of the {licence} as published by the
Free Software Foundation; {terms}

{what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {licence} for more details.

{end}"""


def received(what: str, licence: str) -> str:
    return f"You should have received a copy of the {licence} along with {what}. If not, see <https://www.gnu.org/licenses/>."


GPL, LGPL, LESSER, AGPL = "GNU General Public License", "GNU Lesser General Public License", "GNU Lesser General Public License", "GNU Affero General Public License"
FRANKLIN = "if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301"
GPL2_END = f"You should have received a copy of the {GPL} along with this program; {FRANKLIN} USA."
LGPL2_END = f"You should have received a copy of the {LGPL} along with this library; {FRANKLIN} USA"

#: licence -> (text, which of its sentences state it alone, counted from 0).
TEXTS: dict[str, tuple[str, tuple[int, ...]]] = {
    "Apache-2.0": (
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the
License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License.""",
        (0, 2),
    ),
    "MIT": (
        f"""{MIT_GRANT}, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

{AS_IS}""",
        (0,),
    ),
    "MIT-0": (f"{MIT_GRANT}.\n\n{AS_IS}", (0,)),
    "BSD-3-Clause": (BSD_START + BSD_NAME + BSD_END, ()),
    "BSD-2-Clause": (BSD_START + BSD_END, (0,)),
    "ISC": (
        f"""Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.

{ISC_END}""",
        (0,),
    ),
    "0BSD": (f"Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n{ISC_END}", (0,)),
    "Zlib": (
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for
any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use
this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
        (2,),
    ),
    "BSL-1.0": (
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit
the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do
so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the
following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the
Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source
language processor.""",
        (0,),
    ),
    "Unlicense": (
        """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
        (0, 1),
    ),
    "WTFPL": (
        """Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is
allowed as long as the name is changed.

DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION""",
        (0,),
    ),
    "GPL-2.0-or-later": (gnu("This program", GPL, "2", True, GPL2_END), (0,)),
    "GPL-2.0-only": (gnu("This program", GPL, "2", False, GPL2_END), (0,)),
    "GPL-3.0-or-later": (gnu("This program", GPL, "3", True, received("this program", GPL)), (0,)),
    "GPL-3.0-only": (gnu("This program", GPL, "3", False, received("this program", GPL)), (0,)),
    "LGPL-2.1-or-later": (gnu("This library", LGPL, "2.1", True, LGPL2_END), (0,)),
    "LGPL-3.0-or-later": (gnu("This library", LESSER, "3", True, received("this library", LESSER)), (0,)),
    "AGPL-3.0-or-later": (gnu("This program", AGPL, "3", True, received("this program", AGPL)), (0,)),
    "MPL-2.0": (
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
        (0,),
    ),
    "EPL-2.0": (
        """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is
available at https://www.eclipse.org/legal/epl-2.0/""",
        (0,),
    ),
    "CC0-1.0": (
        """To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.""",
        (0,),
    ),
}

#: Names after "licensed under" and the like -> licence.
NAMES = {
    "MIT License": "MIT", "MIT licence": "MIT", "MIT": "MIT",
    "Apache License, Version 2.0": "Apache-2.0", "Apache License 2.0": "Apache-2.0", "Apache 2.0 License": "Apache-2.0", "Apache 2.0": "Apache-2.0", "Apache-2.0": "Apache-2.0",
    "BSD 2-Clause License": "BSD-2-Clause", "BSD 3-Clause License": "BSD-3-Clause", "3-Clause BSD License": "BSD-3-Clause", "2-Clause BSD License": "BSD-2-Clause",
    "ISC License": "ISC", "zlib License": "Zlib", "Boost Software License, Version 1.0": "BSL-1.0", "Unlicense": "Unlicense", "WTFPL": "WTFPL",
    "GNU General Public License, version 2": "GPL-2.0", "GNU General Public License v2": "GPL-2.0", "GPLv2": "GPL-2.0", "GNU GPL v2": "GPL-2.0",
    "GNU General Public License, version 3": "GPL-3.0", "GNU General Public License v3": "GPL-3.0", "GNU General Public License v3.0": "GPL-3.0", "GPLv3": "GPL-3.0", "GNU GPL v3": "GPL-3.0",
    "GNU Lesser General Public License, version 2.1": "LGPL-2.1", "LGPLv2.1": "LGPL-2.1", "GNU Lesser General Public License, version 3": "LGPL-3.0", "LGPLv3": "LGPL-3.0",
    "GNU Affero General Public License, version 3": "AGPL-3.0", "AGPLv3": "AGPL-3.0",
    "Mozilla Public License 2.0": "MPL-2.0", "Mozilla Public License, v. 2.0": "MPL-2.0", "Mozilla Public License, version 2.0": "MPL-2.0", "MPL 2.0": "MPL-2.0",
    "Eclipse Public License 2.0": "EPL-2.0", "CC0 1.0": "CC0-1.0", "CC0 1.0 Universal": "CC0-1.0",
    "CC BY 4.0": "CC-BY-4.0", "CC BY-SA 4.0": "CC-BY-SA-4.0", "CC BY-NC 4.0": "CC-BY-NC-4.0", "CC BY-ND 4.0": "CC-BY-ND-4.0",
    "CC BY-NC-SA 4.0": "CC-BY-NC-SA-4.0", "CC BY-NC-ND 4.0": "CC-BY-NC-ND-4.0", "CC BY 3.0": "CC-BY-3.0", "CC BY-SA 3.0": "CC-BY-SA-3.0",
    "Creative Commons Attribution 4.0 International License": "CC-BY-4.0",
    "Creative Commons Attribution-ShareAlike 4.0 International License": "CC-BY-SA-4.0",
    "Creative Commons Attribution-NonCommercial 4.0 International License": "CC-BY-NC-4.0",
    "Creative Commons Attribution-NoDerivatives 4.0 International License": "CC-BY-ND-4.0",
    "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License": "CC-BY-NC-SA-4.0",
    "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License": "CC-BY-NC-ND-4.0",
}
#: Identifiers after "SPDX-License-Identifier:" beyond those of TEXTS and NAMES.
IDENTIFIERS = ("LGPL-2.1-only", "LGPL-3.0-only", "AGPL-3.0-only", "Artistic-2.0", "EUPL-1.2", "PSF-2.0", "OFL-1.1", "CDDL-1.0", "Apache-2.0 OR MIT", "MIT OR Apache-2.0")
#: Sentences that reserve everything.
RESERVED = ("All rights reserved",)
