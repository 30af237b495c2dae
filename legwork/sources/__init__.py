"""Reading landed files, planning what to fetch, and writing tables."""
