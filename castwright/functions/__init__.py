"""Column functions: text kernel, URL rules, base64 and text decoding."""
