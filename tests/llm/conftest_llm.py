"""Texts that every operator must handle: null, empty, blank, no letter, very long, odd."""

ODD = [None, "", "   \t\n", "12 + 3 = 15 !!", "a", "x" * 30_000, "wörd " * 6_000,
       "é \U0001f600 漢字 \x1c\x85    end", "\x00\x01 control", "the the the the the"]
