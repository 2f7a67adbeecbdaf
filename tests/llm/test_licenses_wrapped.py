"""Licence texts wrapped as they are in files."""

from creditgrade.llm import licenses

MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY.
"""
BSD3 = """Copyright (c) 2020, Someone
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
"""
GPL3 = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful.
"""
GPL2 = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.
"""
CASES = {
    MIT: ("MitGrant,MitCondition,AsIs", "MIT"),
    MIT.replace("\n", "\r\n"): ("MitGrant,MitCondition,AsIs", "MIT"),
    BSD3: ("AllRights,BsdRedistribution,BsdEndorse,AsIs", "BSD-3-Clause"),
    GPL3: ("GplNoticeThree", "GPL-3.0"),
    GPL2: ("GplFree,GplVersionTwo", "GPL-2.0"),
    "Released under the MIT License\nLicensed under\nCC BY 4.0": ("MitNotice,CcBy", "CC-BY-4.0,MIT"),
    "All rights\nreserved.": ("AllRights", "Proprietary"),
    "All rights\n\nreserved.": ("", ""),
}


def test_wrapped(spark):
    docs = spark.createDataFrame([(text,) for text in CASES], "text string")
    found = licenses.with_licences(docs, "text").collect()
    assert {r["text"]: (",".join(r["sentence_ids"]), ",".join(r["licences"])) for r in found} == CASES
