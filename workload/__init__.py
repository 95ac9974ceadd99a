"""The library's operators over the supplied tables, and what each should give."""
