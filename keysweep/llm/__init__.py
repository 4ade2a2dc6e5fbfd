"""Operators for preparing the text of a large training corpus. Nothing outside this folder imports them."""
