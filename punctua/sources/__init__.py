"""Reading and writing: archive XML, day files, master data, reports."""
