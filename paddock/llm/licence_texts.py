"""Licence phrases and notices that ``licence_scan`` looks for, unless told otherwise.

All words are compared in lower case and without punctuation.
"""

# Fixed values: (label, phrase) whose places the base columns count.
BASE_PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]

# Fixed values: (label, phrase) that name a licence more exactly or another one.
PHRASES = [
    ("agpl", "gnu affero general public license"),
    ("apache-2.0", "apache license version 2 0"),
    ("bsd", "bsd license"),
    ("cc-by", "creative commons attribution"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-nd", "cc by nd"),
    ("cc-by-sa", "cc by sa"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc0", "cc0 1 0 universal"),
    ("epl", "eclipse public license"),
    ("gpl-2.0", "gnu general public license version 2"),
    ("gpl-3.0", "gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("mpl-2.0", "mozilla public license version 2 0"),
    ("unlicense", "released into the public domain"),
]

# Fixed values: (label, mandatory key phrases, the notice's words) of public licence notices.
NOTICES = [
    ("mit", ["permission is hereby granted free of charge", "without warranty of any kind"],
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
     "and associated documentation files (the \"Software\"), to deal in the Software without "
     "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
     "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
     "Software is furnished to do so, subject to the following conditions: The above copyright notice "
     "and this permission notice shall be included in all copies or substantial portions of the "
     "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
     "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
     "AND NONINFRINGEMENT."),
    ("isc", ["permission to use copy modify and or distribute this software"],
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
     "fee is hereby granted, provided that the above copyright notice and this permission notice "
     "appear in all copies."),
    ("apache-2.0", ["under the apache license", "without warranties or conditions of any kind"],
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
     "in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
     "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
     "language governing permissions and limitations under the License."),
    ("gpl", ["gnu general public license as published by the free software foundation"],
     "This program is free software: you can redistribute it and/or modify it under the terms of the "
     "GNU General Public License as published by the Free Software Foundation, either version 3 of the "
     "License, or (at your option) any later version. This program is distributed in the hope that it "
     "will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
     "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("bsd", ["redistribution and use in source and binary forms"],
     "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met: Redistributions of source code must retain the "
     "above copyright notice, this list of conditions and the following disclaimer. Redistributions in "
     "binary form must reproduce the above copyright notice, this list of conditions and the following "
     "disclaimer in the documentation and/or other materials provided with the distribution."),
    ("mpl-2.0", ["mozilla public license"],
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
     "the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("unlicense", ["public domain"],
     "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
     "modify, publish, use, compile, sell, or distribute this software, either in source code form or "
     "as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("zlib", ["this software is provided as is without any express or implied warranty"],
     "This software is provided 'as-is', without any express or implied warranty. In no event will the "
     "authors be held liable for any damages arising from the use of this software. Permission is "
     "granted to anyone to use this software for any purpose, including commercial applications, and "
     "to alter it and redistribute it freely, subject to the following restrictions"),
]
