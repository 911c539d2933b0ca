"""Paths and texts that the tests share."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

#: Texts of the defined cases: null, empty, white space, ties, repeats, marks, other scripts, very long.
ODD = [None, "", " \t\n", "One", "one", "One", "a b c d e f", "###", "中文 \U0001f642 x<|endoftext|>y", "it's 'Re  two\n\n!'s",
       "x" * 30_000, "long word " * 8_000]
