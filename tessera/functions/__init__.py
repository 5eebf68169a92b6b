"""Part of tessera; see the README for what lives here."""
