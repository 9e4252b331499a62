"""What ties the library to the test tables; not part of the library."""
