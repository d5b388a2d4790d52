"""Web-corpus building on PySpark: pages in, clean language-labelled text out."""
