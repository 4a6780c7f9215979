"""Sources: HTML pages, uploaded files and documents, transcript segments."""
