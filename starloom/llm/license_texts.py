"""Texts by which documents state their licence."""

from __future__ import annotations

# Notices and licence texts as their publishers word them, without
# the copyright line.  A name is the licence's SPDX identifier, and which text of it.
_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
    "shall be included in all copies or substantial portions of the Software.")
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission.")
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC_END = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES "
    "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
    "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
    "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"

TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "MIT line": "Released under the MIT License.",
    "GPL-2.0 line": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-2.0 line": "This work is licensed under the GNU Library General Public License, version 2.",
    "LGPL-2.1 line": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-3.0 line": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0 line": "This work is licensed under the GNU Affero General Public License, version 3.",
    "EPL-2.0 line": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES "
        "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."),
    "MIT text": f"{_MIT} {_WARRANTY}",
    "MIT grant": _MIT,
    "ISC text": f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_END}",
    "ISC grant": f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies.",
    "0BSD text": f"{_ISC}. {_ISC_END}",
    "BSD-2-Clause text": f"{_BSD_CONDITIONS} {_BSD_DISCLAIMER}",
    "BSD-2-Clause conditions": _BSD_CONDITIONS,
    "BSD-3-Clause text": f"{_BSD_CONDITIONS} {_BSD_NAMES} {_BSD_DISCLAIMER}",
    "BSD-3-Clause conditions": f"{_BSD_CONDITIONS} {_BSD_NAMES}",
    "Zlib text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
        "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: The origin of this "
        "software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a "
        "product, an acknowledgment in the product documentation would be appreciated but is not required. Altered source versions must be "
        "plainly marked as such, and must not be misrepresented as being the original software. This notice may not be removed or altered "
        "from any source distribution."),
    "BSL-1.0 header": "Distributed under the Boost Software License, Version 1.0. See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt",
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Unlicense text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means."),
    "Unlicense line": "This is free and unencumbered software released into the public domain.",
    "CC0-1.0 line": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}

# The GNU headers and the Creative Commons notices differ in name and version only.
for _id, _name, _version in [("GPL-2.0", "GNU General Public License", "2"), ("GPL-3.0", "GNU General Public License", "3"),
                             ("LGPL-2.0", "GNU Library General Public License", "2"), ("LGPL-2.1", "GNU Lesser General Public License", "2.1"), ("LGPL-3.0", "GNU Lesser General Public License", "3"),
                             ("AGPL-3.0", "GNU Affero General Public License", "3")]:
    TEMPLATES[f"{_id} header"] = (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the {_name} as "
        f"published by the Free Software Foundation, either version {_version} of the License, or (at your option) any later version.")
for _version, _realm in [("4.0", "International"), ("3.0", "Unported")]:
    for _code, _name in [("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
                         ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
                         ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")]:
        TEMPLATES[f"CC-{_code}-{_version} line"] = f"Licensed under CC {_code} {_version}."
        TEMPLATES[f"CC-{_code}-{_version} notice"] = f"This work is licensed under a Creative Commons {_name} {_version} {_realm} License."

#: Words that tell licences of one family apart: a text's stretch must hold
#: each as often as the template does.  Families by a part of the licence's name.
DECIDING = {
    "CC-": ("sharealike", "sa", "noncommercial", "nc", "noderivatives", "noderivs", "nd"),
    "GPL-": ("lesser", "affero"),
}
