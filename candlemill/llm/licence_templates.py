"""Short licence notices by family, and texts about licences that grant nothing."""

# Names of public licences that have versions.
VERSIONED = {
    "AGPL-3.0": ("GNU Affero General Public License", "3"),
    "Apache-1.1": ("Apache License", "1.1"),
    "Apache-2.0": ("Apache License", "2.0"),
    "GPL-1.0": ("GNU General Public License", "1"),
    "GPL-2.0": ("GNU General Public License", "2"),
    "GPL-3.0": ("GNU General Public License", "3"),
    "LGPL-2.1": ("GNU Lesser General Public License", "2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License", "3"),
    "MPL-1.1": ("Mozilla Public License", "1.1"),
    "MPL-2.0": ("Mozilla Public License", "2.0"),
}
# Customary short notices of them, and the headers of the GNU licences.
SHORT_FORMS = (
    "Licensed under the {name}, version {version}.",
    "This work is licensed under the {name}, version {version}.",
    "Released under the {name} {version}.",
)
GNU_FORMS = (
    "This {thing} is free software: you can redistribute it and/or modify it under the terms "
    "of the {name} as published by the Free Software Foundation, either version {version} of the "
    "License, or (at your option) any later version.",
    "This {thing} is free software; you can redistribute it and/or modify it under the terms "
    "of the {name} version {version} as published by the Free Software Foundation.",
)

# The variants of a family of licences for works, by their short names.
CREATIVE_COMMONS = {
    "BY": "Attribution",
    "BY-NC": "Attribution-NonCommercial",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-SA": "Attribution-ShareAlike",
}
CC_FORMS = (
    "Licensed under CC {short} 4.0.",
    "This work is licensed under a Creative Commons {name} 4.0 International License.",
)

# Customary notices that offer two licences.
_EITHER = (
    "Licensed under either of Apache License, Version 2.0 or MIT license at your option.",
    "Available under either of Apache License, Version 2.0 or MIT license.",
    "Dual licensed under the Apache License, Version 2.0 or the MIT License.",
)

# Customary notices of public licences, beside those of the forms.
OTHERS = {
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License.",
        "Licensed under the Apache 2.0 license.",
        *_EITHER,
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the "
        "LICENSE file.",
        "Released under the BSD License.",
    ),
    "BSD-2-Clause": (
        "Licensed under the 2-Clause BSD License.",
        "Released under the BSD 2-Clause License.",
    ),
    "BSD-3-Clause": (
        "Licensed under the 3-Clause BSD License.",
        "Released under the BSD 3-Clause License.",
    ),
    "BSD-4-Clause": (
        "Licensed under the 4-Clause BSD License.",
        "Released under the BSD 4-Clause License.",
    ),
    "CC0-1.0": (
        "Released into the public domain under CC0 1.0.",
        "This work is dedicated to the public domain under the Creative Commons CC0 1.0 Universal "
        "license.",
    ),
    "ISC": (
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "The MIT License (MIT) Copyright",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software",
        *_EITHER,
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "Unlicense": (
        "Released under the Unlicense.",
        "This is free and unencumbered software released into the public domain.",
    ),
}


def _templates() -> dict[str, tuple[str, ...]]:
    """All notices by family, with the identifiers that stand in file headers."""
    found: dict[str, list[str]] = {}
    for family, (name, version) in VERSIONED.items():
        gnu = name.startswith("GNU")
        written = [version] + ([version + ".0"] if "." not in version else [])
        own = [f.format(name=name, version=v) for f in SHORT_FORMS for v in written]
        thing = "library" if "Lesser" in name else "program"
        if gnu:
            own += [f.format(thing=thing, name=name, version=version) for f in GNU_FORMS]
        found[family] = own
    for short, name in CREATIVE_COMMONS.items():
        found[f"CC-{short}-4.0"] = [f.format(short=short, name=name) for f in CC_FORMS]
    for family, notices in OTHERS.items():
        found.setdefault(family, []).extend(notices)
    for family, notices in found.items():
        if family == "BSD":
            continue
        gnu = VERSIONED.get(family, ("",))[0].startswith("GNU")
        ends = ("", "-only", "-or-later") if gnu else ("",)
        notices += [f"SPDX-License-Identifier: {family}{end}" for end in ends]
    return {family: tuple(notices) for family, notices in sorted(found.items())}


TEMPLATES = _templates()

# Texts with the same words that are no licence grant.
UNKNOWN = (
    "All rights reserved. No license is granted.",
    "He lost his driving licence after the accident.",
    "The city issues a new business license every year.",
    "Copyright belongs to the respective authors.",
    "See the license file for details.",
    "The license agreement was signed in version 3 of the contract.",
    "A license is required to fish in this lake.",
    "Ask the publisher for a license before you copy this work.",
    "The school of MIT offers a course on license law.",
    "Permission was denied by the operator, and no license was shown.",
    "The warranty does not cover damage by water, says the license.",
    "Licensed professionals work under the rules of the state.",
    "The Apache helicopter is built under license.",
    "A general public meeting discussed the license, version after version.",
    "The terms of the license are not known.",
    "This software is provided under a commercial license.",
)

# Words of paragraphs about licences, which are counted even if
# they hold no notice. Every notice above holds one of them.
CUES = (
    "licen", "redistribut", "permission", "copyright", "public domain", "unencumbered", "spdx",
    "cc0", "cc by", "cc-by",
)

# Words that deny a grant when they stand before one of its verbs.
DENIALS = ("not", "never", "longer", "t", "nor")
GRANTS = (
    "licensed", "released", "available", "distributed", "covered", "governed", "subject", "under",
    "dedicated", "offered",
)
